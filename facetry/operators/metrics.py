"""Confusion counts and the precision / recall / F1 reports built on them.

Only the confusion count touches the data. It has at most classes x classes rows per
aspect and is combined on the map side, so one dominant class costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetry.functions.arrays import argmax_class, checked_vector
from facetry.schema import CLASSES

KEYS = ("aspect_idx",)


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def line_up(parts: Sequence[DataFrame], keys: Sequence[str], error: str) -> DataFrame:
    """One row per key with the columns of all parts, which must each hold every key exactly once.

    The parts are stacked and grouped, one exchange for any number of them; a key that a part
    lacks or repeats is an error. Columns besides the keys have different names.
    """
    stacked = None
    for n, part in enumerate(parts):
        marked = part.withColumn("_part", F.lit(n))
        stacked = marked if stacked is None else stacked.unionByName(marked, allowMissingColumns=True)
    values = [c for part in parts for c in part.columns if c not in keys]
    grouped = stacked.groupBy(*keys).agg(
        *[F.max(F.col(f"`{c}`")).alias(c) for c in values],
        *[F.count_if(F.col("_part") == n).alias(f"_n{n}") for n in range(len(parts))],
    )
    return grouped.where(_all_once([f"_n{n}" for n in range(len(parts))], error)).select(*keys, *values)


def _all_once(counts: Sequence[str], error: str) -> Column:
    once = F.lit(True)
    for c in counts:
        once = once & (F.col(c) == 1)
    return F.when(once, F.lit(True)).otherwise(F.raise_error(F.lit(error)).cast("boolean"))


def align(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Match two tables row for row on their keys; a row on one side only, or twice, is an error."""
    return line_up([left, right], keys, "rows of the two tables do not match")


def confusion(pairs: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``(keys, y, yhat, n)`` from rows that hold gold ``y`` and predicted ``yhat``; a null is an error."""
    counts = pairs.groupBy(*keys, "y", "yhat").agg(F.count(F.lit(1)).alias("n"))
    missing = F.raise_error(F.lit("a label is null")).cast("long")
    unknown = F.col("y").isNull() | F.col("yhat").isNull()
    return counts.withColumn("n", F.when(unknown, missing).otherwise(F.col("n")))


def ensemble_confusion(scores: DataFrame, gold: DataFrame, models: Sequence[str]) -> DataFrame:
    """Average the models, classify, compare with gold and count, with one wide exchange.

    ``scores`` ``(id, aspect_idx, model, p)`` and ``gold`` ``(id, aspect_idx, y)`` are
    stacked and grouped on ``(id, aspect_idx)``; the group holds running sums only. Each
    group must have every model once, with a whole vector, and gold once.
    """
    size = len(CLASSES)
    stacked = (
        scores.where(F.col("model").isin(*models))
        .withColumn("p", checked_vector("p"))
        .select("id", "aspect_idx", "model", *[F.col("p")[i].alias(f"_p{i}") for i in range(size)])
        .unionByName(
            gold.select("id", "aspect_idx", "y"), allowMissingColumns=True
        )
    )
    grouped = stacked.groupBy("id", "aspect_idx").agg(
        *[F.avg(f"_p{i}").alias(f"_p{i}") for i in range(size)],
        *[F.count_if(F.col("model") == m).alias(f"_n{j}") for j, m in enumerate(models)],
        # a null vector has no numbers to average
        F.count("_p0").alias("_scored"),
        F.count_if(F.col("model").isNull()).alias("_gold"),
        F.max("y").alias("y"),
    )
    complete = (F.col("_gold") == 1) & (F.col("_scored") == len(models))
    for j in range(len(models)):
        complete = complete & (F.col(f"_n{j}") == 1)
    label = argmax_class(F.array(*[F.col(f"_p{i}") for i in range(size)]))
    failed = F.raise_error(F.lit("models and gold labels do not match row for row")).cast("int")
    return confusion(
        grouped.select("aspect_idx", "y", F.when(complete, label).otherwise(failed).alias("yhat"))
    )


def class_report(conf: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Precision, recall, F1 and support of every class seen in gold or prediction."""
    hit = F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(F.lit(0))
    sides = conf.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("y").alias("class"), F.col("n").alias("actual"),
                         F.lit(0).cast("long").alias("predicted"), hit.cast("long").alias("tp")),
                F.struct(F.col("yhat").alias("class"), F.lit(0).cast("long").alias("actual"),
                         F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
            )
        ).alias("s"),
    ).select(*keys, "s.*")
    sums = sides.groupBy(*keys, "class").agg(
        F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"), F.sum("actual").alias("actual")
    )
    return sums.select(
        *keys,
        "class",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("actual")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("predicted") + F.col("actual")).alias("f1"),
        F.col("actual").alias("support"),
        "tp",
    )


def report_summary(report: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Accuracy with macro and support-weighted means per aspect, from ``class_report``."""
    total = F.sum("support")
    weighted = [
        (F.sum(F.col(m) * F.col("support")) / total).alias(f"weighted_{m}")
        for m in ("precision", "recall", "f1")
    ]
    return report.groupBy(*keys).agg(
        (F.sum("tp") / total).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")],
        *weighted,
        total.alias("support"),
    )


def macro(conf: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Macro precision, recall and F1 per key, over the union of gold and predicted classes."""
    return class_report(conf, keys).groupBy(*keys).agg(
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
    )


def mean_f1(per_aspect: DataFrame, aspects: int = 20) -> DataFrame:
    """The headline score: mean F1 over all aspects, an error if one is missing."""
    agg = per_aspect.agg(F.avg("f1").alias("f1"), F.count(F.lit(1)).alias("_n"))
    failed = F.raise_error(F.lit(f"expected {aspects} aspects")).cast("double")
    return agg.select(F.when(F.col("_n") == aspects, F.col("f1")).otherwise(failed).alias("mean_f1"))


def running_best(history: DataFrame, key: str = "aspect_idx") -> DataFrame:
    """Best F1 so far after each epoch."""
    seen = Window.partitionBy(key).orderBy("epoch").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return history.withColumn("best_f1", F.max("f1").over(seen))


def best_epoch(history: DataFrame, key: str = "aspect_idx") -> DataFrame:
    """The first epoch that reaches the best F1."""
    return history.groupBy(key).agg(
        F.max_by("epoch", F.struct("f1", -F.col("epoch"))).alias("epoch"), F.max("f1").alias("f1")
    )
