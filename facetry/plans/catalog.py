"""The registered queries: every operator on whole tables of the given data set.

``documents`` stands in for reviews, ``embeddings`` for word vectors and for score vectors,
``benchmark`` for phrase lists and dictionaries, ``labels`` for gold labels. The texts are
Latin script, so the Han operators run on a letter-by-letter transliteration.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from facetry.functions import text as tx
from facetry.functions.arrays import (
    argmax_class,
    format_score_vector,
    format_token_list,
    one_hot,
    parse_score_vector,
    parse_token_list,
)
from facetry.operators import bayes
from facetry.operators import encode as enc
from facetry.operators import metrics, models, phrases, scores, segment, vectors, vocabulary
from facetry.operators.joins import drop_listed
from facetry.plans import preprocess
from facetry.schema import ASPECT_COLUMNS, aspect_table, route_table
from facetry.session import ensure_checkpoint_dir, fits_broadcast, materialize, read_spread
from facetry.sources.artifacts import build_if_absent, load_embeddings, load_vocabulary, save_table
from facetry.sources.lists import read_lines, read_stop_words, write_lines
from facetry.sources.reviews import read_reviews, write_csv
from facetry.sources.vectors import read_vectors_text, write_vectors_text

# Parameters of the queries below; the oracle uses the same ones.
LATIN = "abcdefghijklmnopqrstuvwxyzé"
HAN = "一不很好吃面店贵的了在有人我他这个上们来到时大地为子鿿"
EMOJI_FROM = "qxwkjvzUN!"
EMOJI_TO = "😀❤️👩‍🏽💻🇨🇳⭐"
STOP_CHARS = ["的", "了", "在", "，", ".", "!", "7", "没有"]
STOP_WORDS = ["the", "of", "and", "de", "la", "le", "der", "die", "und"]
WORD = r"[\p{L}]+"
DIM = 64
HIDDEN = 3
ATTENTION = [((7 * i) % 11 - 5) / 10 for i in range(DIM)]
W_QUERY = [[((i + 2 * j) % 5 - 2) / 4 for j in range(HIDDEN)] for i in range(4)]
W_STEP = [[((i * (j + 1)) % 7 - 3) / 8 for j in range(HIDDEN)] for i in range(DIM)]
W_OUT = [0.5, -0.75, 0.25]
W_OUT_LARGE = [500.0, -750.0, 250.0]
B_QUERY = [0.125, -0.25, 0.5]
B_STEP = [0.25, 0.0, -0.125]
MAXLEN = 1200
TWINS = ["e"]
PHRASE_SIZES = [6, 12, 24, 48]
ODD_TOKENS = [" ", "\n", "", "a b", "\\", "\\n", "\t", "2 3"]
FREQ_BASE, FREQ_ADDED = 3, 20000

Query = Callable[[SparkSession, str], DataFrame]


def step_bias(t):
    """The attention bias of the steps ``t`` (an array), for texts of any length."""
    return ((3 * t) % 7 - 3) / 20


def _documents(spark: SparkSession, sf: str, text: Column | None = None) -> DataFrame:
    docs = read_spread(spark, f"{sf}/documents.parquet", "doc_id", "doc_id", "text")
    return docs.select(F.col("doc_id").alias("id"), (F.col("text") if text is None else text).alias("text"))


def han(text: Column) -> Column:
    return F.translate(F.lower(text), LATIN, HAN)


def _han(spark, sf):
    return _documents(spark, sf, han(F.col("text")))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _word_docs(spark, sf):
    return _documents(spark, sf).select("id", words(F.col("text")).alias("tokens"))


def _char_docs(spark, sf):
    return _documents(spark, sf).select("id", tx.char_tokens(F.lower("text")).alias("tokens"))


def _joined(tokens: str, by: str = "|") -> Column:
    return F.array_join(tokens, by)


def _as_doc(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("id", "doc_id")


# --- scores from the embeddings table -----------------------------------------------------


def _p(aspect: int | Column, offset: int | Column) -> Column:
    """Four consecutive embedding entries as the score vector of an aspect (0-based)."""
    return F.array(
        *[F.col("embedding")[(aspect * 8 + offset + k) % DIM].cast("double") for k in range(4)]
    )


def _vectors(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet")


def _per_aspect(spark, sf, *columns: str) -> DataFrame:
    """Each vector once per aspect, ``a`` counting from 0."""
    rows = _vectors(spark, sf).select(*columns, F.explode(F.sequence(F.lit(0), F.lit(19))).alias("a"))
    return rows.withColumn("aspect_idx", F.col("a") + 1)


def _long_scores(spark, sf):
    offsets = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(o).alias("o")) for m, o in (("bigru", 0), ("capsule", 4))])
    rows = _per_aspect(spark, sf, "vec_id", "embedding").select("*", F.explode(offsets).alias("m"))
    return rows.select(
        F.col("vec_id").alias("id"), "aspect_idx", "m.model", _p(F.col("a"), F.col("m.o")).alias("p")
    )


def _wide_scores(spark, sf, offset):
    cells = [_p(a, offset).alias(name) for a, name in enumerate(ASPECT_COLUMNS)]
    return _vectors(spark, sf).select(F.col("vec_id").alias("id"), *cells)


def _gold_label(aspect: int | Column) -> Column:
    return ((F.col("vec_id") * 7 + aspect) % 4 - 2).cast("int")


def _wide_gold(spark, sf):
    cells = [_gold_label(a).alias(name) for a, name in enumerate(ASPECT_COLUMNS)]
    return _vectors(spark, sf).select(F.col("vec_id").alias("id"), *cells)


def _long_gold(spark, sf):
    rows = _per_aspect(spark, sf, "vec_id")
    return rows.select(F.col("vec_id").alias("id"), "aspect_idx", _gold_label(F.col("a")).alias("y"))


def _confusion(spark, sf):
    return metrics.ensemble_confusion(
        _long_scores(spark, sf), _long_gold(spark, sf), ("bigru", "capsule")
    )


def _round(df: DataFrame, *columns: str, places: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def soft_vote_macro_f1(spark, sf):
    per_aspect = metrics.macro(_confusion(spark, sf)).join(F.broadcast(aspect_table(spark)), "aspect_idx")
    return _round(per_aspect.select("aspect_idx", "aspect", "precision", "recall", "f1"), "precision", "recall", "f1")


def mean_macro_f1(spark, sf):
    return _round(metrics.mean_f1(metrics.macro(_confusion(spark, sf))), "mean_f1")


def classification_report(spark, sf):
    report = metrics.class_report(_confusion(spark, sf)).drop("tp")
    return _round(report, "precision", "recall", "f1")


def classification_summary(spark, sf):
    summary = metrics.report_summary(metrics.class_report(_confusion(spark, sf)))
    return _round(summary, *[c for c in summary.columns if c not in ("aspect_idx", "support")])


def average_score_vectors(spark, sf):
    mean = scores.average_models(_long_scores(spark, sf), ("bigru", "capsule"))
    return mean.select(
        F.col("id").alias("vec_id"), "aspect_idx",
        *[F.round(F.col("p")[k], 9).alias(f"p{k}") for k in range(4)],
        argmax_class("p").alias("yhat"),
    )


def average_score_tables(spark, sf):
    wide = scores.average_wide(_wide_scores(spark, sf, 0), _wide_scores(spark, sf, 4))
    return wide.withColumnRenamed("id", "vec_id")


def route_by_aspect(spark, sf):
    wide = scores.routed_labels(_long_scores(spark, sf), route_table(spark))
    return wide.withColumnRenamed("id", "vec_id")


def picked_aspects(spark, sf):
    chosen = scores.pick_aspects(_long_scores(spark, sf), (3, 6, 18)).join(
        F.broadcast(aspect_table(spark)), "aspect_idx"
    )
    return scores.classify(chosen).select(
        F.col("id").alias("vec_id"), "aspect_idx", "code", "aspect", "model", "yhat"
    )


def wide_to_long(spark, sf):
    return scores.wide_to_long(_wide_gold(spark, sf)).select(F.col("id").alias("vec_id"), "aspect_idx", "aspect", "y")


def long_to_wide(spark, sf):
    labels = scores.classify(_long_scores(spark, sf).where("model = 'bigru'"))
    return scores.long_to_wide(labels, "yhat").withColumnRenamed("id", "vec_id")


def aligned_gold(spark, sf):
    predicted = scores.classify(_long_scores(spark, sf).where("model = 'capsule'")).select("id", "aspect_idx", "yhat")
    pairs = metrics.align(predicted, _long_gold(spark, sf), ("id", "aspect_idx"))
    return metrics.confusion(pairs)


def one_hot_labels(spark, sf):
    hot = _long_gold(spark, sf).withColumn("h", one_hot("y"))
    return hot.select(F.col("id").alias("vec_id"), "aspect_idx", *[F.col("h")[k].alias(f"h{k}") for k in range(4)])


def _history(spark, sf):
    """Macro scores with the ``label`` column of the vectors standing in for the epoch."""
    rows = _per_aspect(spark, sf, "vec_id", "embedding", "label")
    pairs = rows.select(
        "aspect_idx", F.col("label").alias("epoch"), _gold_label(F.col("a")).alias("y"),
        argmax_class(_p(F.col("a"), 0)).alias("yhat"),
    )
    keys = ("aspect_idx", "epoch")
    return metrics.macro(metrics.confusion(pairs, keys), keys)


def best_so_far_f1(spark, sf):
    best = metrics.running_best(_history(spark, sf)).select("aspect_idx", "epoch", "f1", "best_f1")
    return _round(best, "f1", "best_f1")


def best_epoch(spark, sf):
    return _round(metrics.best_epoch(_round(_history(spark, sf), "f1")), "f1")


def score_vector_text_roundtrip(spark, sf):
    rows = _long_scores(spark, sf).withColumn("p", parse_score_vector(format_score_vector("p")))
    return rows.select(
        F.col("id").alias("vec_id"), "aspect_idx", "model",
        *[F.round(F.col("p")[k], 9).alias(f"p{k}") for k in range(4)],
    )


# --- character work -----------------------------------------------------------------------


def keep_han(spark, sf):
    return _as_doc(_han(spark, sf).withColumn("text", tx.keep_han("text")))


def keep_non_han(spark, sf):
    return _as_doc(_han(spark, sf).withColumn("text", tx.keep_non_han("text", STOP_CHARS)))


def symbol_lines(spark, sf):
    docs = _han(spark, sf).where(tx.has_non_han("text", STOP_CHARS))
    return _as_doc(docs.withColumn("text", tx.keep_non_han("text", STOP_CHARS)))


def char_class_counts(spark, sf):
    return _as_doc(_han(spark, sf).select("id", *[c.alias(n) for n, c in tx.char_class_counts("text").items()]))


def char_class_totals(spark, sf):
    """Each character tested on its own, counted over the corpus."""
    chars = _han(spark, sf).select(F.explode_outer(tx.char_tokens("text")).alias("c")).where("c IS NOT NULL")
    c = F.col("c")
    return chars.groupBy("c").agg(F.count(F.lit(1)).alias("n")).select(
        "c", "n", tx.is_han(c).alias("han"), tx.not_han(c).alias("not_han"),
        tx.is_digit(c).alias("digit"), tx.is_letter(c).alias("letter"), tx.is_blank(c).alias("blank"),
    )


def strip_symbols(spark, sf):
    return _as_doc(_han(spark, sf).withColumn("text", tx.strip_symbols("text")))


def strip_symbols_latin(spark, sf):
    return _as_doc(_documents(spark, sf).withColumn("text", tx.strip_symbols("text")))


def drop_stop_chars(spark, sf):
    return _as_doc(_han(spark, sf).withColumn("text", tx.drop_stop_chars("text", STOP_CHARS)))


def spaced_chars(spark, sf):
    return _as_doc(_han(spark, sf).withColumn("text", tx.spaced_chars("text", STOP_CHARS)))


def char_tokens(spark, sf):
    kept = preprocess.preprocess_chars(_han(spark, sf), STOP_CHARS, "text")
    return _as_doc(kept.select("id", F.size("tokens").alias("n_tokens"), _joined("tokens").alias("tokens")))


def list_text_roundtrip(spark, sf):
    tokens = _documents(spark, sf).select("id", tx.char_tokens("text").alias("t"))
    back = tokens.withColumn("t", parse_token_list(format_token_list("t")))
    return _as_doc(back.select("id", F.size("t").alias("n_tokens"), F.array_join("t", "").alias("text")))


# --- emoji, emoticons, lines --------------------------------------------------------------


def _emoji_docs(spark, sf):
    return _documents(spark, sf, F.translate("text", EMOJI_FROM, EMOJI_TO))


def emoji_list(spark, sf):
    rows = _emoji_docs(spark, sf).select("id", F.posexplode_outer(tx.emojis("text")).alias("ord", "emoji"))
    return _as_doc(rows.where("emoji IS NOT NULL"))


def emoji_counts(spark, sf):
    found = _emoji_docs(spark, sf).select(F.explode_outer(tx.emojis("text")).alias("emoji")).where("emoji IS NOT NULL")
    return found.groupBy("emoji").agg(F.count(F.lit(1)).alias("n"))


def distinct_chars(spark, sf):
    docs = _emoji_docs(spark, sf).withColumn("text", F.translate("text", "\n", ""))
    return vocabulary.distinct_in_order(docs, tx.char_tokens("text"))


def distinct_lines(spark, sf):
    return vocabulary.distinct_in_order(_documents(spark, sf), F.split("text", "\n"), "line")


def dictionary_lines(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    return turns.select("conv_id", "turn", tx.with_frequency("text").alias("line"))


def _phrase_list(spark, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select(
        F.col("item_id").alias("id"),
        F.filter(F.transform(F.split("text", "[.,\n]"), lambda x: F.btrim(x)), lambda x: x != "").alias("parts"),
    )
    return materialize(vocabulary.distinct_in_order(items, "parts", "token").withColumnRenamed("idx", "ord"))


def phrase_hits(spark, sf):
    return _as_doc(phrases.phrase_hits(_documents(spark, sf), _phrase_list(spark, sf)))


def phrase_counts(spark, sf):
    return _as_doc(phrases.phrase_counts(_documents(spark, sf), _phrase_list(spark, sf)))


def _large_phrase_list(spark, sf):
    """Thousands of phrases, many with a common start: beginnings of all lines of the conversations."""
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    lines = turns.select(F.explode_outer(F.split("text", "\n")).alias("line"), F.explode(F.lit(PHRASE_SIZES)).alias("k"))
    phrases_ = lines.where(F.length("line") >= F.col("k")).select(F.expr("left(line, k)").alias("token")).distinct()
    return materialize(vocabulary.number_rows(phrases_, "token", name="ord"))


def phrase_hits_large(spark, sf):
    return _as_doc(phrases.phrase_hits(_documents(spark, sf), _large_phrase_list(spark, sf)))


def phrase_hits_joined(spark, sf):
    """The same long list as a table: the texts are searched with its Bloom filter."""
    return _as_doc(phrases.phrase_hits(_documents(spark, sf), _large_phrase_list(spark, sf), small=False))


def occurrence_counts(spark, sf):
    """How often one phrase occurs in each text, without building hits."""
    return _as_doc(_documents(spark, sf).select("id", tx.count_occurrences("text", "erer").alias("n")))


# --- vocabulary and encoding --------------------------------------------------------------


def vocab_fit(spark, sf):
    return vocabulary.fit_vocabulary(_char_docs(spark, sf))


def vocab_fit_words(spark, sf):
    return vocabulary.fit_vocabulary(_word_docs(spark, sf))


def _seq_text(df: DataFrame) -> DataFrame:
    return _as_doc(df.select("id", F.size("seq").alias("n"), F.array_join(F.transform("seq", lambda x: x.cast("string")), " ").alias("seq")))


def _benchmark_vocab(spark, sf):
    """A vocabulary fitted on other texts, so that documents hold unknown words."""
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    fit_on = items.select(F.col("item_id").alias("id"), words(F.col("text")).alias("tokens"))
    return vocabulary.fit_vocabulary(fit_on)


def vocab_lookup(spark, sf):
    return _seq_text(enc.lookup(_word_docs(spark, sf), _benchmark_vocab(spark, sf)))


def vocab_lookup_zero(spark, sf):
    return _seq_text(enc.lookup(_word_docs(spark, sf), _benchmark_vocab(spark, sf), keep_unknown=True))


def vocab_lookup_joined(spark, sf):
    """The shuffle plan for vocabularies that are too large to broadcast."""
    vocab = _benchmark_vocab(spark, sf)
    return _seq_text(enc.lookup_by_join(_word_docs(spark, sf), vocab, keep_unknown=True, block_tokens=1 << 16))


def encode_pad(spark, sf):
    vocab = vocabulary.fit_vocabulary(_char_docs(spark, sf))
    return _seq_text(enc.encode_chars(_documents(spark, sf, F.lower("text")), vocab, MAXLEN))


def encode_pad_words(spark, sf):
    return _seq_text(enc.encode(_word_docs(spark, sf), _benchmark_vocab(spark, sf), MAXLEN))


# --- words --------------------------------------------------------------------------------


def _dictionary(spark, sf, text: Column, pattern: str):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    found = items.select(F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("token"))
    return found.groupBy("token").agg(F.count(F.lit(1)).alias("freq"))


def segment_longest_match(spark, sf):
    docs = _documents(spark, sf, F.lower("text"))
    cut = segment.segment(docs, _dictionary(spark, sf, F.lower("text"), WORD))
    return _as_doc(cut.select("id", F.size("tokens").alias("n_tokens"), _joined("tokens", "/").alias("tokens")))


def segment_likeliest(spark, sf):
    docs = _documents(spark, sf, F.lower("text"))
    cut = segment.segment(docs, _dictionary(spark, sf, F.lower("text"), WORD), "frequency")
    return _as_doc(cut.select("id", F.size("tokens").alias("n_tokens"), _joined("tokens", "/").alias("tokens")))


def segment_large_dictionary(spark, sf):
    """Longest match under a dictionary of all words of the documents."""
    docs = _documents(spark, sf, F.lower("text"))
    found = docs.select(F.explode_outer(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("token"))
    listed = found.where("token IS NOT NULL").groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    cut = segment.segment(docs, listed)
    return _as_doc(cut.select("id", F.size("tokens").alias("n_tokens"), _joined("tokens", "/").alias("tokens")))


def segment_joined(spark, sf):
    """The same dictionary as a table, which a Bloom filter stands for in the scan."""
    docs = _documents(spark, sf, F.lower("text"))
    found = docs.select(F.explode_outer(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("token"))
    listed = found.where("token IS NOT NULL").groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    cut = segment.segment(docs, listed, small=False)
    return _as_doc(cut.select("id", F.size("tokens").alias("n_tokens"), _joined("tokens", "/").alias("tokens")))


def word_tokens(spark, sf):
    """Word mode of preprocessing on Han text: strip symbols, segment, drop stop words."""
    dictionary = _dictionary(spark, sf, han(F.col("text")), r"[\x{4e00}-\x{9fff}]+")
    cut = preprocess.preprocess_words(_han(spark, sf), dictionary, STOP_CHARS, "text")
    return _as_doc(cut.select("id", F.size("tokens").alias("n_tokens"), _joined("tokens", "/").alias("tokens")))


def stop_words_removed(spark, sf):
    kept = _word_docs(spark, sf).withColumn("tokens", tx.without_stop_words("tokens", STOP_WORDS))
    return _as_doc(kept.select("id", F.size("tokens").alias("n_tokens"), _joined("tokens", " ").alias("tokens")))


def stop_words_joined(spark, sf):
    """Words of the documents that occur in no benchmark item, by anti-join, counted."""
    stop = materialize(_dictionary(spark, sf, F.lower("text"), WORD).select("token"))
    rows = _word_docs(spark, sf).select(F.explode_outer("tokens").alias("token")).where("token IS NOT NULL")
    counted = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return drop_listed(counted, stop, "token", fits_broadcast(stop, "token"))


def keywords_top40(spark, sf):
    return _as_doc(_round(segment.keywords(_word_docs(spark, sf), 40), "weight", places=6))


def extended_dictionary(spark, sf):
    base = _dictionary(spark, sf, F.lower("text"), WORD).withColumn("freq", F.lit(FREQ_BASE))
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    added = turns.select(F.explode_outer(words(F.col("text"))).alias("token")).where("token IS NOT NULL").distinct()
    return segment.extend_dictionary(base, added, FREQ_ADDED)


# --- vectors ------------------------------------------------------------------------------


def _word_vectors(spark, sf, vocab):
    """Vectors belong to the words in order; later words have none."""
    return vocab.join(_ranked_vectors(spark, sf), "idx").select("token", "v")


def _ranked_vectors(spark, sf):
    """Indexes count from 1, ``vec_id`` from 0."""
    return _vectors(spark, sf).select((F.col("vec_id") + 1).alias("idx"), F.col("embedding").alias("v"))


def embedding_rows(spark, sf):
    vocab = vocabulary.fit_vocabulary(_word_docs(spark, sf))
    rows = vectors.embedding_rows(vocab, _word_vectors(spark, sf, vocab), DIM)
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return rows.select(
        "idx", F.size("v").alias("dim"), F.round(F.col("v")[0].cast("double"), 6).alias("first"),
        F.round(F.col("v")[DIM - 1].cast("double"), 6).alias("last"), F.round(total, 6).alias("total"),
    )


def _sequences(spark, sf):
    """Whole word sequences and the embedding rows that are not zero."""
    docs = _word_docs(spark, sf)
    vocab = vocabulary.fit_vocabulary(docs)
    given = _ranked_vectors(spark, sf)
    return enc.lookup(docs, vocab), materialize(given.join(vocab.select("idx"), "idx", "left_semi"))


def _dims(df: DataFrame, column: str) -> DataFrame:
    rows = df.select(F.col("id").alias("doc_id"), F.posexplode_outer(column).alias("dim", "value"))
    return rows.withColumn("value", F.round("value", 6))


def _pooled(kind: str) -> Query:
    def query(spark, sf):
        seqs, rows = _sequences(spark, sf)
        weights = ATTENTION if kind == "attention" else None
        return _dims(vectors.pool(seqs, rows, DIM, (kind,), weights, step_bias), kind)

    return query


def _pooled_by_join(kind: str) -> Query:
    """The plan for embedding tables that are too large to broadcast."""

    def query(spark, sf):
        seqs, rows = _sequences(spark, sf)
        weights = ATTENTION if kind == "attention" else None
        return _dims(vectors.pool(seqs, rows, DIM, (kind,), weights, step_bias, in_tasks=False), kind)

    return query


def _query_attention(w_out: list[float], in_tasks: bool | None = None) -> Query:
    def query(spark, sf):
        seqs, rows = _sequences(spark, sf)
        asked = seqs.withColumn("q", F.array(*[F.pmod(F.col("id") + i, F.lit(5)) / 5.0 for i in range(4)]))
        pooled = vectors.query_attention_pool(
            asked, rows, DIM, W_QUERY, W_STEP, w_out, B_QUERY, B_STEP, step_bias, in_tasks=in_tasks
        )
        return _dims(pooled, "attention")

    return query


def document_features(spark, sf):
    seqs, rows = _sequences(spark, sf)
    pooled = vectors.pool(seqs, rows, DIM, attention_weights=ATTENTION, step_bias=step_bias)
    return _dims(vectors.document_features(pooled), "features")


def word2vec_train(spark, sf):
    """Character vectors of the raw texts, size 100, window 10, 15 iterations. SQL cannot state their values, so a
    property is shown: at odd places a character is replaced by a twin, which then has the same
    neighbours, and the token nearest to the twin must be the character it stands for.
    """
    chars = F.transform(
        tx.char_tokens(F.lower("text")),
        lambda c, i: F.when((i % 2 == 1) & c.isin(*TWINS), F.upper(c)).otherwise(c),
    )
    docs = _documents(spark, sf).where(F.length("text") > 0).select(chars.alias("tokens"))
    trained = materialize(vectors.train_vectors(docs))
    finite = F.forall("v", lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(1e6)))
    near = vectors.nearest_tokens(trained, [c.upper() for c in TWINS])
    shown = trained.select("token", F.size("v").alias("dim"), finite.alias("finite"))
    return shown.join(F.broadcast(near), "token", "left")


# --- files --------------------------------------------------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def csv_roundtrip(spark, sf):
    """All 22 columns written in another order, and read back by name."""
    labels = [((F.col("id") * 7 + a) % 4 - 2).cast("int").alias(c) for a, c in enumerate(ASPECT_COLUMNS)]
    table = _documents(spark, sf).select(*reversed(labels), F.col("text").alias("content"), "id")
    path = _scratch(spark, "reviews")
    write_csv(table, path)
    back = read_reviews(spark, path)
    return back.withColumnsRenamed({"id": "doc_id", "content": "text"})


def csv_append(spark, sf):
    """Rows appended to a file that is there: the even ids, then the odd ones."""
    path = _scratch(spark, "appended")
    docs = _documents(spark, sf)
    empty = [F.lit(None).cast("int").alias(c) for c in ASPECT_COLUMNS]
    table = docs.select("id", F.col("text").alias("content"), *empty)
    write_csv(table.where("id % 2 = 0"), path)
    write_csv(table.where("id % 2 = 1"), path, "append")
    return read_reviews(spark, path).select(F.col("id").alias("doc_id"), F.col("content").alias("text"))


def stop_words_file(spark, sf):
    """Every document's lines as entries of a stop list: trimmed, distinct, none empty."""
    path = _scratch(spark, "stop")
    lines = _documents(spark, sf).select(F.explode_outer(F.split("text", "\n")).alias("line"))
    write_lines(lines.select(F.concat(F.lit(" \t"), "line", F.lit(" ")).alias("line")), "line", path)
    return read_stop_words(spark, path)


def line_list_roundtrip(spark, sf):
    """Lines written and read, counted because a file's lines have no key."""
    path = _scratch(spark, "lines")
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    write_lines(turns.select(F.translate("text", "\r\n", "  ").alias("line")), "line", path)
    return read_lines(spark, path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


def vocabulary_roundtrip(spark, sf):
    path = _scratch(spark, "vocabulary")
    save_table(vocabulary.fit_vocabulary(_word_docs(spark, sf)), path)
    return load_vocabulary(spark, path)


def embedding_roundtrip(spark, sf):
    path = _scratch(spark, "embedding")
    save_table(_ranked_vectors(spark, sf), path)
    rows = load_embeddings(spark, path).select("idx", F.posexplode("v").alias("dim", "value"))
    return rows.withColumn("value", F.round(F.col("value").cast("double"), 6))


def build_if_absent_twice(spark, sf):
    """Kept on the first call, read on the second, whose own plan is never built."""
    path = _scratch(spark, "kept")
    counts = spark.read.parquet(f"{sf}/documents.parquet").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    build_if_absent(spark, path, lambda: counts)
    return build_if_absent(spark, path, lambda: counts.where("false"))


def build_if_stale(spark, sf):
    """Word counts kept of half of the documents, built again when the rest is added, then taken as they are."""
    given, path = _scratch(spark, "given"), _scratch(spark, "kept")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    words = F.size(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))

    def kept(keep: bool) -> DataFrame:
        def counts() -> DataFrame:
            return spark.read.parquet(given).select("doc_id", words.alias("n_tokens")).where(F.lit(keep))

        return build_if_absent(spark, path, counts, {"documents": given}, {"word": WORD})

    docs.where("doc_id % 2 = 0").write.parquet(given)
    kept(True)
    docs.where("doc_id % 2 = 1 OR doc_id IS NULL").write.mode("append").parquet(given)
    kept(True)
    return kept(False)  # not built: nothing has changed


def vector_file_roundtrip(spark, sf):
    """Tokens with blanks, line breaks, backslashes and nothing at all among them."""
    path = _scratch(spark, "vectors")
    odd = F.array(*[F.lit(t) for t in ODD_TOKENS])
    token = F.coalesce(F.get(odd, F.col("vec_id").cast("int")), F.col("vec_id").cast("string"))
    write_vectors_text(_vectors(spark, sf).select(token.alias("token"), F.col("embedding").alias("v")), path)
    rows = read_vectors_text(spark, path).select("token", F.posexplode("v").alias("dim", "value"))
    return rows.withColumn("value", F.round(F.col("value").cast("double"), 6))


# --- models -------------------------------------------------------------------------------

# How often a letter occurs stands in for the label of an aspect: 20 aspects of 4 classes. Models learn
# from the documents of even id; every document is scored, and those of odd id evaluate.
ASPECT_LETTERS = "etaoinsrhldcumfpgbvk"
CLASS_BORDERS = (2, 5, 8)  # occurrences per 100 characters, from which the next class begins
STEPS, STEP, REG = 3, 2.0, 0.01


def _letter_counts(letters: str):
    """A text to how often each letter occurs in it, null to zeros; texts are read once per letter."""

    @arrow_udf("array<int>")
    def count(texts):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        each = [pc.count_substring(texts, letter) for letter in letters]
        flat = np.column_stack([pc.fill_null(n, 0).to_numpy(zero_copy_only=False) for n in each]).astype(np.int32).ravel()
        offsets = np.arange(len(texts) + 1, dtype=np.int32) * len(letters)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return count


def _letter_labels(spark, sf) -> DataFrame:
    """``(id, <20 label columns>)``; an empty text has no label."""
    counted = _documents(spark, sf).select(
        "id", F.length("text").alias("size"), _letter_counts(ASPECT_LETTERS)("text").alias("n")
    )
    cells = []
    for place, name in enumerate(ASPECT_COLUMNS):
        label = F.lit(-2)
        for border in CLASS_BORDERS:
            label = label + (F.col("n")[place] * 100 >= F.col("size") * border).cast("int")
        cells.append(F.when(F.col("size") > 0, label).alias(name))
    return counted.select("id", *cells)


def _odd(df: DataFrame, remainder: int) -> DataFrame:
    return df.where(F.pmod("id", F.lit(2)) == remainder)


def aspect_scores(spark, sf):
    """20 aspects of 4 classes: trained together by plain gradient steps over the mean vectors of half of the
    documents, kept, read again and applied to all documents.
    """
    seqs, rows = _sequences(spark, sf)
    features = materialize(vectors.pool(seqs, rows, DIM, ("mean",)).withColumnRenamed("mean", "features"))
    table = models.training_table(_odd(features, 0), _letter_labels(spark, sf))
    path = _scratch(spark, "models")
    models.train(table, path, passes=STEPS, reg=REG, step=STEP)
    scored = models.score(features, path, epoch=STEPS)
    # two classes that no training document has are equally likely, but for the last bits
    rounded = scored.withColumn("p", F.transform("p", lambda x: F.round(x, 6)))
    four = [F.col("p")[k].alias(f"p{k}") for k in range(4)]
    return rounded.select(F.col("id").alias("doc_id"), "aspect_idx", *four, argmax_class("p").alias("yhat"))


def aspect_epochs(spark, sf):
    """F1 after each of eight passes, on documents that no model learned from, within one training run."""
    seqs, rows = _sequences(spark, sf)
    pooled = vectors.pool(seqs, rows, DIM, attention_weights=ATTENTION, step_bias=step_bias)
    table = models.training_table(vectors.document_features(pooled), _letter_labels(spark, sf))
    path = _scratch(spark, "models")
    models.train(_odd(table, 0), path, passes=8, reg=REG, validation=_odd(table, 1))
    return _round(models.history(spark, path, 8), "precision", "recall", "f1", "best_f1", places=6)


# The two binary columns of ``labels`` stand in for two aspects of two classes.
LABEL_ASPECTS = {1: "quality", 2: "toxic"}


def _naive_bayes(small: bool | None) -> Query:
    def query(spark, sf):
        """Every document scored over all its words, learned from the even labelled ids."""
        docs = _word_docs(spark, sf)
        vocab = vocabulary.fit_vocabulary(docs)
        size, aspects = max(1, vocab.count()), tuple(LABEL_ASPECTS)
        packed = bayes.pack(enc.lookup(docs, vocab))
        labels = _odd(spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("doc_id", "id"), 0)
        path = _scratch(spark, "bayes")
        save_table(bayes.train(packed, labels, size, aspects, LABEL_ASPECTS, (0, 1)), path)
        scored = bayes.score(packed, spark.read.parquet(path), size, docs.schema["id"].dataType, aspects, (0, 1), small=small)
        return scored.select(
            F.col("id").alias("doc_id"), "aspect_idx", F.round(F.col("p")[0], 6).alias("p0"),
            F.round(F.col("p")[1], 6).alias("p1"), "yhat",
        )

    return query


QUERIES: dict[str, Query] = {
    "soft_vote_macro_f1": soft_vote_macro_f1,
    "mean_macro_f1": mean_macro_f1,
    "classification_report": classification_report,
    "classification_summary": classification_summary,
    "average_score_vectors": average_score_vectors,
    "average_score_tables": average_score_tables,
    "route_by_aspect": route_by_aspect,
    "picked_aspects": picked_aspects,
    "wide_to_long": wide_to_long,
    "long_to_wide": long_to_wide,
    "aligned_gold": aligned_gold,
    "one_hot_labels": one_hot_labels,
    "best_so_far_f1": best_so_far_f1,
    "best_epoch": best_epoch,
    "score_vector_text_roundtrip": score_vector_text_roundtrip,
    "keep_han": keep_han,
    "keep_non_han": keep_non_han,
    "symbol_lines": symbol_lines,
    "char_class_counts": char_class_counts,
    "char_class_totals": char_class_totals,
    "strip_symbols": strip_symbols,
    "strip_symbols_latin": strip_symbols_latin,
    "drop_stop_chars": drop_stop_chars,
    "spaced_chars": spaced_chars,
    "char_tokens": char_tokens,
    "list_text_roundtrip": list_text_roundtrip,
    "emoji_list": emoji_list,
    "emoji_counts": emoji_counts,
    "distinct_chars": distinct_chars,
    "distinct_lines": distinct_lines,
    "dictionary_lines": dictionary_lines,
    "phrase_hits": phrase_hits,
    "phrase_counts": phrase_counts,
    "phrase_hits_large": phrase_hits_large,
    "phrase_hits_joined": phrase_hits_joined,
    "occurrence_counts": occurrence_counts,
    "vocab_fit": vocab_fit,
    "vocab_fit_words": vocab_fit_words,
    "vocab_lookup": vocab_lookup,
    "vocab_lookup_zero": vocab_lookup_zero,
    "vocab_lookup_joined": vocab_lookup_joined,
    "encode_pad": encode_pad,
    "encode_pad_words": encode_pad_words,
    "segment_longest_match": segment_longest_match,
    "segment_likeliest": segment_likeliest,
    "segment_large_dictionary": segment_large_dictionary,
    "segment_joined": segment_joined,
    "word_tokens": word_tokens,
    "stop_words_removed": stop_words_removed,
    "stop_words_joined": stop_words_joined,
    "keywords_top40": keywords_top40,
    "extended_dictionary": extended_dictionary,
    "embedding_rows": embedding_rows,
    "mean_pool": _pooled("mean"),
    "max_pool": _pooled("max"),
    "attention_pool": _pooled("attention"),
    "mean_pool_joined": _pooled_by_join("mean"),
    "max_pool_joined": _pooled_by_join("max"),
    "attention_pool_joined": _pooled_by_join("attention"),
    "query_attention_pool": _query_attention(W_OUT),
    "query_attention_pool_joined": _query_attention(W_OUT_LARGE, in_tasks=False),
    "document_features": document_features,
    "word2vec_train": word2vec_train,
    "csv_roundtrip": csv_roundtrip,
    "csv_append": csv_append,
    "stop_words_file": stop_words_file,
    "line_list_roundtrip": line_list_roundtrip,
    "vocabulary_roundtrip": vocabulary_roundtrip,
    "embedding_roundtrip": embedding_roundtrip,
    "build_if_absent_twice": build_if_absent_twice,
    "build_if_stale": build_if_stale,
    "vector_file_roundtrip": vector_file_roundtrip,
    "aspect_scores": aspect_scores,
    "aspect_epochs": aspect_epochs,
    "aspect_naive_bayes": _naive_bayes(None),
    "aspect_naive_bayes_joined": _naive_bayes(False),
}
