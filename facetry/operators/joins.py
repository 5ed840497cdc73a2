"""Joins against lookup tables that may or may not be small, on keys that may be hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32


def salted_join(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Shuffle join that spreads every key over ``salts`` tasks.

    The salt comes from the whole row, so it is the same when a lost task is run again.
    The lookup side is repeated once per salt. ``how`` is inner, left, left_semi or left_anti.
    """
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).alias("_salt")
    copies = F.explode(F.expr(f"sequence(0L, {salts - 1}L)"))
    return (
        rows.select("*", spread)
        .join(lookup.withColumn("_salt", copies), [*keys, "_salt"], how)
        .drop("_salt")
    )


def lookup_join(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], small: bool, how: str = "inner"
) -> DataFrame:
    """Broadcast a lookup table that was measured to be small, else join it salted."""
    if small:
        return rows.join(F.broadcast(lookup), list(keys), how)
    return salted_join(rows, lookup, keys, how)


def drop_listed(rows: DataFrame, listed: DataFrame, key: str, small: bool) -> DataFrame:
    """Rows whose ``key`` is not in ``listed`` (distinct), e.g. exploded tokens minus stop words."""
    return lookup_join(rows, listed.select(key), [key], small, "left_anti").select(*rows.columns)


def without_listed_tokens(docs: DataFrame, listed: DataFrame, small: bool) -> DataFrame:
    """``docs(id, tokens, ..)`` without the tokens in ``listed(token)``, order and repeats kept.

    The way for stop lists too long for an expression. Ids are unique; a text without tokens left
    has an empty array, a null one stays null.
    """
    rows = docs.select("id", F.posexplode_outer("tokens").alias("_pos", "token")).where("token IS NOT NULL")
    kept = lookup_join(rows, listed.select("token").distinct(), ["token"], small, "left_anti")
    back = kept.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("_pos", "token"))).alias("_t"))
    empty = F.array().cast("array<string>")
    tokens = F.when(F.col("tokens").isNotNull(), F.coalesce(F.col("_t.token"), empty))
    return docs.join(back, "id", "left").withColumn("tokens", tokens).drop("_t")
