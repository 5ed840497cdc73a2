"""Token arrays to trained per-aspect models and back to scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from facetry.functions.text import lower_tokens
from facetry.operators import models
from facetry.operators.encode import encode
from facetry.operators.models import ALL_ASPECTS
from facetry.operators.scores import wide_to_long
from facetry.operators.vectors import document_features, embedding_rows, pool
from facetry.operators.vocabulary import fit_vocabulary
from facetry.schema import ASPECT_COLUMNS, MAXLEN
from facetry.sources.artifacts import build_if_absent


def prepare(
    spark: SparkSession, train_tokens: DataFrame, vectors: DataFrame, dim: int, out_dir: str
) -> tuple[DataFrame, DataFrame]:
    """Vocabulary and embedding rows of the training split, each built if absent or out of date."""
    lowered = train_tokens.select("id", lower_tokens("tokens").alias("tokens"))
    vocab = build_if_absent(
        spark, f"{out_dir}/vocabulary", lambda: fit_vocabulary(lowered), {"tokens": train_tokens}
    )
    rows = build_if_absent(
        spark,
        f"{out_dir}/embeddings",
        lambda: embedding_rows(vocab, vectors, dim),
        {"vocabulary": f"{out_dir}/vocabulary", "vectors": vectors},
        {"dim": dim},
    )
    return vocab, rows


def features(
    tokens: DataFrame,
    vocab: DataFrame,
    embeddings: DataFrame,
    dim: int,
    attention_weights: Sequence[float] | None = None,
    maxlen: int = MAXLEN,
) -> DataFrame:
    """``(id, features)``: encode, then mean, max and attention pooling end to end."""
    lowered = tokens.select("id", lower_tokens("tokens").alias("tokens"))
    pooled = pool(
        encode(lowered, vocab, maxlen),
        embeddings,
        dim,
        attention_weights=attention_weights or [1.0 / dim] * dim,
    )
    return document_features(pooled)


def train_all(
    spark: SparkSession,
    train_tokens: DataFrame,
    vectors: DataFrame,
    dim: int,
    out_dir: str,
    aspects: Sequence[int] = ALL_ASPECTS,
    epochs: int = 8,
    validation_tokens: DataFrame | None = None,
) -> None:
    """Train all aspects by ``epochs`` passes and keep every pass; both tables carry the labels.

    ``validation_tokens`` are classified after every pass within the same run (``models.history``).
    """
    vocab, rows = prepare(spark, train_tokens, vectors, dim, out_dir)

    def table(tokens: DataFrame) -> DataFrame:
        return models.training_table(features(tokens, vocab, rows, dim), tokens.select("id", *ASPECT_COLUMNS))

    held = None if validation_tokens is None else table(validation_tokens)
    models.train(table(train_tokens), f"{out_dir}/models", aspects, epochs, validation=held)


def validate_all(
    spark: SparkSession,
    tokens: DataFrame,
    dim: int,
    out_dir: str,
    aspects: Sequence[int] = ALL_ASPECTS,
    epochs: Sequence[int] = (8,),
) -> DataFrame:
    """Metrics of kept passes on any labelled table, with the best F1 so far."""
    vocab = spark.read.parquet(f"{out_dir}/vocabulary")
    rows = spark.read.parquet(f"{out_dir}/embeddings")
    gold = wide_to_long(tokens.select("id", *ASPECT_COLUMNS)).select("id", "aspect_idx", "y")
    gold = gold.where(gold.aspect_idx.isin(*aspects))
    return models.epoch_history(
        features(tokens, vocab, rows, dim), gold, f"{out_dir}/models", aspects, epochs
    )
