"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetry.llm import (
    alignment,
    exact_dedup,
    langid,
    mixing,
    pieces,
    quality,
    simhash,
    substrings,
    topk,
    toxicity,
    url_filter,
    vector_codes,
    warc,
)
from facetry.llm.common import held_out, table
from facetry.session import materialize, read_spread

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"

# (host, path, verdict)
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Documents with at least one task per core; tables of enough files are read as they are."""
    return read_spread(spark, f"{sf}/documents.parquet", "doc_id", *columns)


def op1_warc(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages", "page_id", "url", "html")
    # the archives are written to the shared folder and read from there
    archives = materialize(warc.write_archives(pages))
    found = warc.read_archives(archives)
    wrong = F.raise_error(F.concat_ws(": ", "archive", "error"))
    return found.select(
        F.when(F.col("error").isNotNull(), wrong.cast("long")).otherwise(F.col("page_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


def op2_topk(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings", "vec_id", "embedding")
    return topk.top_k(rows, F.col("id") % 50 == 0, k=5, scale=256)


def op3_langid(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf, "doc_id", "text", "lang")
    model = langid.train(docs, ~held_out("doc_id", 4, 2))
    made = langid.predict(docs, model)
    return made.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf, "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.simhash_groups(documents(spark, sf, "doc_id", "text"), words=3, max_bits=2)


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = documents(spark, sf, "doc_id", "text"), table(spark, sf, "labels", "doc_id", "toxic")
    model = toxicity.train(docs, labels, ~held_out("doc_id", 5, 0))
    made = toxicity.predict(docs, model)
    return made.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = documents(spark, sf, "doc_id", "text"), table(spark, sf, "labels", "doc_id", "quality")
    model = quality.train(docs, labels, ~held_out("doc_id", 3, 1))
    made = quality.predict(docs, model)
    return made.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")


def op8_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf, "doc_id", "text"))


def op9_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf, "pages", "page_id", "url"), rules)


def op10_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.encode(documents(spark, sf, "doc_id", "text"), PIECE_MODEL, check=True)


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    found = alignment.align(documents(spark, sf, "doc_id", "text"), BYTE_MODEL, PIECE_MODEL)
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256")
    )


def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_spread(spark, f"{sf}/embeddings.parquet", "vec_id", "vec_id", "embedding", "label")
    vectors = vector_codes.whole_vectors(rows, "vec_id", "embedding", 256, "label")
    books = vector_codes.train(vectors, parts=16, entries=64, rounds=2)
    coded = vector_codes.with_label_error(vector_codes.encode(vectors, books), "_label")
    return coded.select(
        F.col("id").alias("vec_id"),
        vector_codes.hex_code("code").alias("code"),
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )


def op13_substrings(spark: SparkSession, sf: str) -> DataFrame:
    found = substrings.repeated_passages(documents(spark, sf, "doc_id", "text"), window=50)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_warc,
        op2_topk,
        op3_langid,
        op4_mixing,
        op5_simhash,
        op6_toxicity,
        op7_quality,
        op8_exact_dedup,
        op9_url_filter,
        op10_sentencepiece,
        op11_alignment,
        op12_vector_codes,
        op13_substrings,
    )
}
