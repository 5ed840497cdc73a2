"""Connected components of a link table, by contraction; no component meets in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetry.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``links`` (a long, b long); component: smallest node.

    Each round every node points to its smallest neighbour if that is smaller than itself, the
    pointers are followed to their ends by doubling, and the links are rewritten between those
    ends. Rounds end when no link is left between different ends. Both ends of all steps are
    written to the checkpoint folder, so a lost executor costs one step. Joins are plain shuffles
    of two written tables, which adaptive execution splits where a node has very many links.
    """
    both = links.where("a <> b").select("a", "b")
    edges = materialize(
        both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = materialize(edges.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node")))
    while edges.limit(1).count():
        # nodes of this round with their smallest neighbour
        parent = materialize(edges.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p")))
        moving = True
        while moving:
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("q"))
            jumped = materialize(
                parent.join(up, "p", "left").select("a", F.coalesce("q", "p").alias("r"), F.col("p").alias("old"))
            )
            moving = jumped.where("r <> old").limit(1).count() > 0
            parent = jumped.select("a", F.col("r").alias("p"))
        parent = materialize(parent)
        labels = materialize(
            labels.join(parent.withColumnRenamed("a", "component"), "component", "left").select(
                "node", F.coalesce("p", "component").alias("component")
            )
        )
        left = parent.select("a", F.col("p").alias("pa"))
        right = parent.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        edges = materialize(
            edges.join(left, "a")
            .join(right, "b")
            .where("pa <> pb")
            .select(F.col("pa").alias("a"), F.col("pb").alias("b"))
            .distinct()
        )
    return labels
