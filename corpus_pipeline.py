"""A training corpus in five stages; every stage works on all rows that the one before kept.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from facetry.llm import exact_dedup, mixing, pieces, quality, simhash
from facetry.llm.common import held_out, table, written
from facetry.llm.queries import PIECE_MODEL


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels not held out."""
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    model = quality.train(docs, labels, ~held_out("doc_id", 3, 1))
    return quality.keep_good(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays."""
    return exact_dedup.drop_copies(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest id stays."""
    return simhash.drop_near_copies(docs, words=3, max_bits=2)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as it is taken, those not taken go."""
    return mixing.mixture(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids, and whether decoding them gives the text back."""
    return pieces.encode(docs, PIECE_MODEL, check=True)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", encode_stage),
]

# The classifier and the tokenizer cannot be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
