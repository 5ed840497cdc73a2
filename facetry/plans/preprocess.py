"""Raw reviews to token arrays, in character or word mode, kept per mode and split."""

from __future__ import annotations

import sys
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetry.functions.text import char_tokens, drop_stop_chars, strip_symbols, without_stop_words
from facetry.operators.joins import without_listed_tokens
from facetry.operators.segment import segment
from facetry.operators.vectors import train_vectors
from facetry.session import fits_broadcast, materialize
from facetry.sources.artifacts import build_if_absent
from facetry.sources.lists import read_dictionary, read_stop_words, stop_word_list
from facetry.sources.reviews import read_reviews

STOP_LIST_MAX = 10_000  # longer stop lists are joined


def preprocess_chars(reviews: DataFrame, stop: Iterable[str], text: str = "content") -> DataFrame:
    """Drop stop characters and blanks, then one token per character."""
    return reviews.withColumn("tokens", char_tokens(drop_stop_chars(text, stop))).drop(text)


def preprocess_words(
    reviews: DataFrame,
    dictionary: DataFrame,
    stop: Iterable[str] | DataFrame,
    text: str = "content",
    method: str = "longest",
) -> DataFrame:
    """Strip symbols, cut into dictionary words, drop stop words.

    ``stop`` is a list of words, or a table ``(token)`` when it is too long for an expression.
    """
    stripped = reviews.withColumn("text", strip_symbols(text)).drop(*({text} - {"text"}))
    words = segment(stripped, dictionary, method).drop("text")
    if isinstance(stop, DataFrame):
        stop = materialize(stop)
        return without_listed_tokens(words, stop, fits_broadcast(stop, "token"))
    return words.withColumn("tokens", without_stop_words("tokens", stop))


def preprocess_split(
    spark: SparkSession,
    csv_path: str,
    out_dir: str,
    split: str,
    mode: str,
    stop_path: str,
    dictionary_path: str | None = None,
) -> DataFrame:
    """One split, built if absent or if its files have changed. The mode is part of the path, so modes never mix."""
    if mode not in ("char", "word"):
        raise ValueError(mode)

    def build() -> DataFrame:
        reviews = read_reviews(spark, csv_path)
        stop = read_stop_words(spark, stop_path)
        if mode == "char":
            # only entries of one character can match, and there are no more of those than code points
            single = stop.where(F.length("token") == 1)
            return preprocess_chars(reviews, stop_word_list(single, sys.maxunicode))
        if dictionary_path is None:
            raise ValueError("word mode needs a dictionary")
        few = stop.limit(STOP_LIST_MAX + 1).count() <= STOP_LIST_MAX
        words = stop_word_list(stop, STOP_LIST_MAX) if few else stop
        return preprocess_words(reviews, read_dictionary(spark, dictionary_path), words)

    inputs = {"reviews": csv_path, "stop": stop_path}
    if mode == "word" and dictionary_path is not None:
        inputs["dictionary"] = dictionary_path
    return build_if_absent(spark, f"{out_dir}/mode={mode}/split={split}", build, inputs, {"stop_list_max": STOP_LIST_MAX})


def character_vectors(spark: SparkSession, csv_path: str, path: str, **params) -> DataFrame:
    """Vectors of the characters of the raw, unfiltered training text, built if absent or out of date."""

    def build() -> DataFrame:
        reviews = read_reviews(spark, csv_path).where(F.col("content").isNotNull())
        return train_vectors(reviews.select(char_tokens("content").alias("tokens")), **params)

    return build_if_absent(spark, path, build, {"reviews": csv_path}, params)
