"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.session import staged


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has one neighbour below it at most, and none both above and below."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    by_node = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return by_node.where("ups > 1 or ups > 0 and least = 0").isEmpty()


def roots(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node with an edge.

    ``edges`` has the columns a and b. Every node is tied to the smallest one in its
    neighbourhood, first from the side of the larger, then of the smaller neighbours,
    until only stars are left (the alternating algorithm of Kiveris et al., 2014). Only
    minima are gathered, never a node's neighbours.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), "edges")
    while not _all_stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = staged(both.join(least, "u").where("v > u and v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(lowest.withColumnRenamed("m", "v"))
        now = staged(small.distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
