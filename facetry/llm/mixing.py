"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Only DataFrame functions. Every source gets a target number of words. Complete epochs come
first: a source whose target is k times its size or more gives all its documents k times. The
rest of the target is filled by weighted sampling without replacement: every document draws an
exponential key, -ln(u) / quality weight, the documents are sorted by key within the source, and
those whose running sum of sizes fits the rest are taken. The document on the border is taken
when that comes nearer to the target. Documents are taken whole.

u comes from the document's id, so reruns and lost tasks draw the same keys.

Targets: the weights (3, 1, 2, repeated over the sources by code point, null last) share
``share`` times all sizes; a target stops at ``most`` times its source's size and the excess is
shared again by weight until none is above. Each round of that is one small aggregation.

No source is sorted in one task: a source of n documents is cut into about sqrt(n) key ranges of
about sqrt(n) documents (the keys' mean places the borders), running sums are taken per range and
the sums of the ranges before are added.

Defined cases: null text has size 0; documents of size 0 are taken as often as the epochs say and
add no words; null ids draw as the text 'null'; ties of keys go to the smaller id and repeated
rows are separate documents; a null or empty source name is a source like any other; empty
tables give empty results. Quality weights must be positive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from facetry.llm.common import BLANKS, WORD
from facetry.operators.vocabulary import number_rows
from facetry.session import materialize

WEIGHTS = (3, 1, 2)
SYMBOLS = "!\"#$%&'()*+,-./0123456789:;<=>?@[\\]^_`{|}~"


def word_count(text: str) -> Column:
    """Runs of characters other than ``[\\x20\\x09-\\x0D]``; null: 0. Each run becomes one letter."""
    marks = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WORD, "x")
    return F.length(F.regexp_replace(marks, BLANKS, "")).cast("long")


def quality_weight(text: str) -> Column:
    """From 0.1 to 1: the share of a text that is neither a digit nor an ASCII symbol."""
    body = F.coalesce(F.col(text), F.lit(""))
    kept = F.length(F.translate(body, SYMBOLS, ""))
    return (F.lit(1.0) + F.lit(9.0) * (kept + 1) / (F.length(body) + 1)) / F.lit(10.0)


def unit(doc_id: str, seed: str) -> Column:
    """Uniform on (0, 1), from the id: 52 bits of an MD5."""
    word = F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(word.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(4503599627370496.0)


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """``sizes``: (source, size), one row per source. Adds ``target``; one aggregation per round."""
    ranked = number_rows(sizes, F.col("source").asc_nulls_last(), name="idx")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("idx") - 1, F.lit(len(weights))))
    open_ = ranked.select(
        "source", "size", weight.alias("weight"), (F.lit(float(most)) * F.col("size")).alias("cap")
    )
    total = open_.agg(F.sum("size")).first()[0] or 0
    level, closed = 0.0, -1
    while True:
        # what is above the level's share is closed at its cap; the rest share what is left
        at_cap = F.col("cap") <= F.lit(level) * F.col("weight")
        state = open_.agg(
            F.coalesce(F.sum(F.when(at_cap, F.col("cap"))), F.lit(0.0)).alias("spent"),
            F.coalesce(F.sum(F.when(~at_cap, F.col("weight"))), F.lit(0.0)).alias("weights"),
            F.count_if(at_cap).alias("closed"),
        ).first()
        if state["closed"] == closed or not state["weights"]:
            break
        closed = state["closed"]
        level = max(level, (share * total - state["spent"]) / state["weights"])
    if state["weights"]:
        fair = F.least(F.lit(level) * F.col("weight"), F.col("cap"))
    else:
        fair = F.col("cap")
    return open_.select("source", "size", fair.alias("target"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    quality: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix:",
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)`` per row of ``docs``."""
    quality = quality_weight(text) if quality is None else quality
    rows = materialize(
        docs.select(
            F.col(doc_id).alias("id"),
            F.col(source).alias("source"),
            word_count(text).alias("size"),
            (-F.log(unit(doc_id, seed)) / quality).alias("key"),
        )
    )
    sums = materialize(
        rows.groupBy("source").agg(
            F.sum("size").alias("size"),
            F.count(F.lit(1)).alias("docs"),
            # the keys' mean places the borders of the ranges
            F.avg("key").alias("mean"),
        )
    )
    targets = source_targets(sums.select("source", "size"), weights, share, most)
    plan = materialize(
        sums.alias("s")
        .join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
        .select(
            F.col("s.source").alias("source"),
            F.col("s.size").alias("source_size"),
            "target",
            "mean",
            F.ceil(F.sqrt("docs")).alias("ranges"),
            F.when(F.col("s.size") > 0, F.floor(F.col("target") / F.col("s.size")))
            .otherwise(F.lit(1))
            .alias("epochs"),
        )
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    placed = _with_plan(rows, plan).withColumn(
        "bucket",
        F.least(
            F.floor(F.col("ranges") * (F.lit(1.0) - F.exp(-F.col("key") / F.col("mean")))),
            F.col("ranges") - 1,
        ),
    )
    within = (
        W.partitionBy("source", "bucket").orderBy("key", "id").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    before = materialize(placed.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    before = before.select("source", "bucket", F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("before"))
    b, p = before.alias("b"), placed.withColumn("run", F.sum("size").over(within)).alias("p")
    summed = p.join(
        b, F.col("p.source").eqNullSafe(F.col("b.source")) & (F.col("p.bucket") == F.col("b.bucket"))
    ).select("p.*", (F.col("before") + F.col("run")).alias("upto"))
    # on the border: taken if at most half of it lies beyond the rest
    extra = (F.col("upto") * 2 - F.col("size") <= F.col("rest") * 2) & (F.col("rest") > 0)
    copies = (F.col("epochs") + extra.cast("long")).alias("copies")
    return summed.select(
        F.col("id").alias(doc_id), F.col("source").alias(source), "size", "source_size", "target", copies
    ).withColumn("taken", F.col("size") * F.col("copies"))


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Each row with its source's plan; large sources are joined in many tasks."""
    salts = 64
    spread = F.pmod(F.xxhash64("id", "key"), F.lit(salts)).alias("salt")
    r = rows.select("*", spread).alias("r")
    p = plan.withColumn("salt", F.explode(F.expr(f"sequence(0L, {salts - 1}L)"))).alias("p")
    return r.join(
        p, F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.salt") == F.col("p.salt"))
    ).select("r.*", "source_size", "target", "mean", "ranges", "epochs", "rest").drop("salt")


def mixture(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with all its columns.

    Rows that repeat an id, source and size are all taken as often as the one taken most.
    """
    mixed = mix(docs, doc_id, text, source, **options).where("copies > 0")
    keys = {"id": F.col(doc_id), "source": F.col(source)}
    chosen = (
        mixed.select(*[c.alias(k) for k, c in keys.items()], "size", "copies")
        .groupBy("id", "source", "size")
        .agg(F.max("copies").alias("copies"))
    )
    chosen = materialize(chosen)
    full = docs.select(F.struct("*").alias("row"), *[c.alias(k) for k, c in keys.items()], word_count(text).alias("size"))
    d, c = full.alias("d"), chosen.alias("c")
    same = F.col("d.id").eqNullSafe(F.col("c.id")) & F.col("d.source").eqNullSafe(F.col("c.source"))
    found = d.join(c, same & (F.col("d.size") == F.col("c.size")))
    return found.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
