"""Combine two models' score tables and measure labels against gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetry.operators.metrics import align, class_report, confusion, macro, mean_f1
from facetry.operators.scores import average_wide, routed_labels
from facetry.schema import ASPECT_COLUMNS, route_table
from facetry.sources.reviews import read_reviews, read_scores, write_csv


def average_files(spark: SparkSession, scores_a: str, scores_b: str, out: str) -> DataFrame:
    """Two score files to one label file by averaging."""
    labels = average_wide(read_scores(spark, scores_a), read_scores(spark, scores_b))
    write_csv(labels, out)
    return labels


def route_scores(spark: SparkSession, scores: DataFrame, routes: dict | None = None) -> DataFrame:
    """Wide labels with each aspect answered by its routed model; gold is never involved."""
    return routed_labels(scores, route_table(spark, routes))


def evaluate(labels: DataFrame, gold: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Class reports, macro scores per aspect and the mean F1 of wide labels against wide gold.

    The tables are matched as one row per review and taken apart into aspects afterwards.
    """
    predicted = labels.select("id", F.array(*ASPECT_COLUMNS).alias("yhat"))
    actual = gold.select("id", F.array(*ASPECT_COLUMNS).alias("y"))
    cells = align(predicted, actual, ["id"]).select(F.posexplode(F.arrays_zip("y", "yhat")).alias("a", "c"))
    counts = confusion(cells.select((F.col("a") + 1).alias("aspect_idx"), "c.y", "c.yhat"))
    per_aspect = macro(counts)
    return class_report(counts), per_aspect, mean_f1(per_aspect)


def evaluate_files(spark: SparkSession, labels: str, gold: str):
    return evaluate(read_reviews(spark, labels), read_reviews(spark, gold))
