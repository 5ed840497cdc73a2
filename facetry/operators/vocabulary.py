"""Vocabularies and other first-seen orders over token arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetry.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def number_rows(df: DataFrame, *order: Column | str, name: str = "idx") -> DataFrame:
    """Consecutive numbers from 1 in the given total order, without a one-task window.

    The rows are sorted by range and written to the checkpoint folder, which fixes their
    partitions. The number is the row's place in its partition plus the sizes of the
    partitions before it; only those sizes, one per partition, come to the driver.
    """
    placed = materialize(df.orderBy(*order)).select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    sizes = {r["_part"]: r["count"] for r in placed.groupBy("_part").count().collect()}
    before, total = [], 0
    for part in range(max(sizes, default=0) + 1):
        before.append(total)
        total += sizes.get(part, 0)
    offsets = F.from_json(F.lit(str(before)), "array<long>")
    return placed.withColumn(name, offsets[F.col("_part")] + F.col("_row") + 1).drop("_part", "_row")


def token_stats(docs: DataFrame, tokens: Column | str = "tokens", token: str = "token") -> DataFrame:
    """``(token, n, first_id, first_rank)`` per distinct token; ``docs`` has a unique ``id``.

    ``first_rank`` orders the tokens by first appearance inside the first document. Each
    document's distinct tokens are laid in front of all its tokens, so one pass yields
    counts and first places. All running values are numbers, which lets Spark hash-combine
    on the map side; the shuffle carries one row per task and token however hot a token is.
    (The outer explode keeps Spark from evaluating the token expression twice, once for an
    inferred emptiness filter.)
    """
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    rows = (
        docs.select("id", tokens.alias("_all"))
        .select("id", "_all", F.array_distinct("_all").alias("_new"))
        .select(
            "id", F.size("_new").alias("_d"), F.posexplode_outer(F.concat("_new", "_all")).alias("_pos", token)
        )
        .where(F.col(token).isNotNull())
    )
    return rows.groupBy(token).agg(
        F.count_if(F.col("_pos") >= F.col("_d")).alias("n"),
        F.min("id").alias("first_id"),
        F.expr("min_by(_pos, id) FILTER (WHERE _pos < _d)").alias("first_rank"),
    )


def fit_vocabulary(docs: DataFrame, tokens: Column | str = "tokens") -> DataFrame:
    """``(token, n, idx)``: most frequent first, ties by first appearance, numbered from 1."""
    stats = token_stats(docs, tokens)
    return number_rows(stats, F.desc("n"), "first_id", "first_rank").select("token", "n", "idx")


def distinct_in_order(docs: DataFrame, values: Column | str, name: str = "value") -> DataFrame:
    """``(value, idx)``: distinct array entries in order of first appearance.

    With ``values`` the characters of a text this is the cleaned emoji list, with its lines
    the cleaned emoticon list.
    """
    values = F.col(values) if isinstance(values, str) else values
    rows = docs.select("id", F.posexplode_outer(F.array_distinct(values)).alias("_rank", name)).where(
        F.col(name).isNotNull()
    )
    firsts = rows.groupBy(name).agg(
        F.min("id").alias("_id"), F.min_by("_rank", "id").alias("_rank")
    )
    return number_rows(firsts, "_id", "_rank").select(name, "idx")
