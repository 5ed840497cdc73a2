"""One entry per line: stop words, emoticons, user-dictionary words, plain review text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetry.functions.text import strip


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(id, value)`` with ``id`` increasing in file order."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("id"), "value")


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed entries as ``(token)``; reading twice gives the same list."""
    entries = spark.read.text(path).select(strip("value").alias("token"))
    return entries.where("token <> ''").distinct()


def stop_word_list(stop: DataFrame, limit: int = 100_000) -> list[str]:
    """A stop list short enough to be part of an expression; longer ones must be joined."""
    head = [r["token"] for r in stop.select("token").limit(limit + 1).collect()]
    if len(head) > limit:
        raise ValueError(f"more than {limit} stop words: use operators.joins.drop_listed")
    return sorted(head)


def read_dictionary(spark: SparkSession, path: str, default_freq: int = 1) -> DataFrame:
    """``(token, freq)`` from ``word`` or ``word freq`` lines."""
    parts = F.split(strip("value"), r"\s+")
    lines = spark.read.text(path).select(parts.alias("p")).where("p[0] <> ''")
    freq = F.coalesce(F.try_element_at("p", F.lit(2)).try_cast("long"), F.lit(default_freq))
    return lines.select(F.col("p")[0].alias("token"), freq.cast("long").alias("freq"))


def write_lines(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)
