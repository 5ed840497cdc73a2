"""Exact duplicates: 128-bit content hash, smallest id stays, bytes compared inside groups.

Only DataFrame functions. Texts are equal when they are identical after every run of
``[\\x20\\x09-\\x0D]`` has become one space; a null text counts as empty.

* Rows are grouped by (hash, text) itself: the hash spreads the groups over the tasks, and the
  aggregation compares the text's bytes, so a hash collision never merges two texts. Copies
  collapse on the map side; a text that is a third of all rows sends one row per task.
* The groups keep (hash, SHA-256, smallest id, rows) and drop the text. Every row finds its
  group again by both digests, with hot groups broadcast. If two different texts shared both
  digests, the run stops with an error instead of merging them.

Defined cases: null ids rank behind all others; a group with null ids only has a null
``keep_id``. Of repeated rows with the id that stays, exactly one is kept. Empty tables give
empty results. Columns besides id and text are not looked at and may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetry.llm.common import BLANKS, attach
from facetry.session import materialize


def normalised(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, " ")


def _groups(docs: DataFrame, doc_id: str, text: str, content_hash: Callable[[Column], Column]):
    """Materialised rows (id, hash, sha, copies) and groups (hash, sha, keep_id, group_size)."""
    plain = docs.select(F.col(doc_id).alias("id"), normalised(text).alias("body"))
    hashed = plain.select("id", "body", content_hash(F.col("body")).alias("hash"))
    groups = materialize(
        hashed.groupBy("hash", "body")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("hash", F.sha2("body", 256).alias("sha"), "keep_id", "group_size")
    )
    twice = groups.groupBy("hash", "sha").count().where("count > 1").limit(1).count()
    if twice:
        raise RuntimeError("two different texts share both digests; choose another content hash")
    rows = materialize(
        hashed.select("id", "hash", F.sha2("body", 256).alias("sha"))
        .groupBy("id", "hash", "sha")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return rows, groups


def exact_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    content_hash: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``."""
    rows, groups = _groups(docs, doc_id, text, content_hash)
    total = rows.count()
    # a group of one row needs no partner: the row itself says all there is to say
    shared = groups.where("group_size > 1")
    found = attach(rows, shared, ["hash", "sha"], "group_size", total)
    alone = F.col("group_size").isNull()
    return found.select(
        F.col("id").alias(doc_id),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
        F.col("sha").alias("text_sha256"),
    ).select(
        doc_id,
        "keep_id",
        "group_size",
        (F.col(doc_id).eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of repeated rows the smallest one."""
    rows, groups = _groups(docs, doc_id, text, F.md5)
    r, g = rows.alias("r"), groups.alias("g")
    keepers = materialize(
        r.join(
            g,
            (F.col("r.hash") == F.col("g.hash"))
            & (F.col("r.sha") == F.col("g.sha"))
            & F.col("r.id").eqNullSafe(F.col("g.keep_id")),
        ).select(F.col("r.id").alias("id"), F.col("r.hash").alias("hash"), "copies")
    )
    # the columns travel as one struct, so that none can clash with the names used here
    full = docs.select(
        F.struct("*").alias("row"), F.col(doc_id).alias("id"), F.md5(normalised(text)).alias("hash")
    )

    def among(kept: DataFrame) -> DataFrame:
        d, k = full.alias("d"), kept.alias("k")
        same = (F.col("d.hash") == F.col("k.hash")) & F.col("d.id").eqNullSafe(F.col("k.id"))
        return d.join(k, same, "left_semi")

    once = among(keepers.where("copies = 1")).select("row")
    repeated = keepers.where("copies > 1")
    if repeated.limit(1).count():
        many = among(repeated).groupBy("hash", "id").agg(F.min("row").alias("row")).select("row")
        once = once.unionByName(many)
    return once.select("row.*")
