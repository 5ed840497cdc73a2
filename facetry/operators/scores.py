"""Long and wide score tables, model averaging and per-aspect routing.

The long form is ``(id, aspect_idx, model, p)`` with ``p`` a vector of four scores. The
scores are independent per class: nothing here assumes they sum to one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetry.functions.arrays import argmax_class, checked_vector
from facetry.operators.metrics import line_up
from facetry.schema import ASPECT_COLUMNS, ASPECT_INDEX, CLASSES


def pick_aspects(long: DataFrame, indexes: Sequence[int]) -> DataFrame:
    return long.where(F.col("aspect_idx").isin(*indexes))


def wide_to_long(
    wide: DataFrame, value: str = "y", columns: Sequence[str] = ASPECT_COLUMNS
) -> DataFrame:
    """One row per (id, aspect) from one row per id, without a shuffle or a lookup."""
    cells = [part for c in columns for part in (F.lit(ASPECT_INDEX[c]), F.lit(c), F.col(c))]
    return wide.select("id", F.stack(F.lit(len(columns)), *cells).alias("aspect_idx", "aspect", value))


def long_to_wide(
    long: DataFrame, value: str = "y", columns: Sequence[str] = ASPECT_COLUMNS
) -> DataFrame:
    """One row per id, by one aggregation.

    A review's rows meet in the scan stage already, so about one row per review is shuffled
    (``pivot`` would group by review and aspect first, and shuffle twice).
    """
    cells = [F.max(F.when(F.col("aspect_idx") == ASPECT_INDEX[c], F.col(value))).alias(c) for c in columns]
    return long.groupBy("id").agg(*cells)


def average_models(scores: DataFrame, models: Sequence[str]) -> DataFrame:
    """Equal-weight mean of the given models' vectors per (id, aspect).

    The models are lined up by grouping instead of joining: one exchange whatever their
    number, with four running sums per group. A group that lacks a model, has one twice, or has
    a vector that is null or not four numbers is an error rather than a wrong mean.
    """
    size = len(CLASSES)
    chosen = scores.where(F.col("model").isin(*models)).withColumn("p", checked_vector("p"))
    sums = chosen.groupBy("id", "aspect_idx").agg(
        *[F.avg(F.col("p")[i]).alias(f"_p{i}") for i in range(size)],
        *[F.count_if(F.col("model") == m).alias(f"_n{j}") for j, m in enumerate(models)],
        F.count("p").alias("_scored"),
    )
    complete = F.col("_scored") == len(models)
    for j in range(len(models)):
        complete = complete & (F.col(f"_n{j}") == 1)
    vector = F.array(*[F.col(f"_p{i}") for i in range(size)])
    return sums.select(
        "id",
        "aspect_idx",
        F.when(complete, vector)
        .otherwise(F.raise_error(F.lit("each model must score each (id, aspect) once")))
        .alias("p"),
    )


def average_wide(a: DataFrame, b: DataFrame, columns: Sequence[str] = ASPECT_COLUMNS) -> DataFrame:
    """Two wide score tables to one wide label table, matched on ``id`` as one row per review.

    Both tables must hold the same ids, each once. Columns of ``a`` besides ``id`` and the
    scores (the review's text) are carried along.

    The label columns are computed in one expression over arrays of vectors; one expression
    per column would outgrow what Spark compiles into a single method.
    """
    kept = [c for c in a.columns if c != "id" and c not in columns]
    left = a.select("id", *kept, F.array(*columns).alias("_a"))
    right = b.select("id", F.array(*columns).alias("_b"))

    def mean(x: Column, y: Column) -> Column:
        return F.zip_with(checked_vector(x), checked_vector(y), lambda p, q: 0.5 * p + 0.5 * q)

    both = line_up([left, right], ["id"], "the two score tables do not match row for row")
    labels = F.transform(F.zip_with("_a", "_b", mean), lambda p: argmax_class(p)).alias("_y")
    named = [F.col("_y")[i].alias(c) for i, c in enumerate(columns)]
    return both.select("id", *kept, labels).select("id", *kept, *named)


def route(scores: DataFrame, routes: DataFrame) -> DataFrame:
    """Keep, for each aspect, the rows of the one model it is routed to.

    ``routes`` holds one row per aspect (20), hence the broadcast.
    """
    return scores.join(F.broadcast(routes), ["aspect_idx", "model"])


def classify(scores: DataFrame) -> DataFrame:
    return scores.withColumn("yhat", argmax_class("p"))


def routed_labels(scores: DataFrame, routes: DataFrame) -> DataFrame:
    """Route, classify and widen. Every review of ``scores`` needs one row of the routed model
    for each aspect: none, two, or a null vector are an error.
    """
    marked = scores.join(
        F.broadcast(routes.withColumn("_routed", F.lit(True))), ["aspect_idx", "model"], "left"
    ).select("id", "aspect_idx", "_routed", F.when(F.col("_routed"), argmax_class("p")).alias("yhat"))
    mine = {c: F.col("_routed") & (F.col("aspect_idx") == ASPECT_INDEX[c]) for c in ASPECT_COLUMNS}
    wide = marked.groupBy("id").agg(
        *[F.max(F.when(m, F.col("yhat"))).alias(c) for c, m in mine.items()],
        *[F.count_if(m).alias(f"_n{ASPECT_INDEX[c]}") for c, m in mine.items()],
    )
    failed = F.raise_error(F.lit("an aspect has no routed model score, or more than one")).cast("int")
    return wide.select(
        "id",
        *[
            F.when((F.col(f"_n{ASPECT_INDEX[c]}") == 1) & F.col(c).isNotNull(), F.col(c)).otherwise(failed).alias(c)
            for c in ASPECT_COLUMNS
        ],
    )
