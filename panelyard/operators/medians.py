"""Exact medians that do not depend on a group fitting into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelyard.session import staged


def exact_medians(df: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Median of each value column per key, nulls skipped, even counts averaged.

    Medians by rank over a range-partitioned table, so no group has to fit into a task:

    1. Count equal values, which also shrinks hot values on the map side.
    2. Range-partition by (key, column, value): a hot group spreads over as many
       partitions as its size asks for. The table is written, so the part a row
       is in stays fixed.
    3. The sizes of the parts give the rank at which each part of a group
       starts; only the parts that hold a middle rank are read again.
    """
    key, values = list(key), list(values)
    pairs = F.array(*[F.struct(F.lit(v).alias("_column"), F.col(v).alias("_value"))
                      for v in values])
    group = [*key, "_column"]
    counted = (df.select(*key, F.inline(pairs)).where(F.col("_value").isNotNull())
               .groupBy(*group, "_value").agg(F.count(F.lit(1)).alias("_n")))
    parts = staged(
        counted.repartitionByRange(*group, "_value")
        .withColumn("_part", F.spark_partition_id()), "ranked_values")

    in_order = Window.partitionBy(*group).orderBy("_part")
    whole = Window.partitionBy(*group)
    sizes = (parts.groupBy(*group, "_part").agg(F.sum("_n").alias("_size"))
             .withColumn("_end", F.sum("_size").over(
                 in_order.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("_total", F.sum("_size").over(whole))
             .withColumn("_low", F.expr("(_total + 1) div 2"))
             .withColumn("_high", F.expr("_total div 2 + 1"))
             .withColumn("_start", F.col("_end") - F.col("_size")))
    holds_middle = ((F.col("_low") > F.col("_start")) & (F.col("_low") <= F.col("_end"))
                    | (F.col("_high") > F.col("_start")) & (F.col("_high") <= F.col("_end")))
    # Written, so that the optimizer knows its size: at most two rows per group
    # and column, it is broadcast when it is small and the other parts stay put.
    wanted = staged(sizes.where(holds_middle)
                    .select(*group, "_part", "_start", "_low", "_high"), "middle_parts")

    same = [F.col(f"v.{c}").eqNullSafe(F.col(f"w.{c}")) for c in [*group, "_part"]]
    near = parts.alias("v").join(wanted.alias("w"), same).select("v.*", "_start", "_low", "_high")
    by_value = (Window.partitionBy(*group, "_part").orderBy("_value")
                .rowsBetween(Window.unboundedPreceding, 0))
    ranked = (near.withColumn("_to", F.col("_start") + F.sum("_n").over(by_value))
              .withColumn("_from", F.col("_to") - F.col("_n")))
    middle = ranked.where((F.col("_high") > F.col("_from")) & (F.col("_low") <= F.col("_to")))
    # The middle values are one or two rows per group: the smallest holds the
    # low rank, the largest the high one.
    medians = middle.groupBy(*group).agg(
        ((F.min("_value") + F.max("_value")) / 2).alias("_median"))
    return medians.groupBy(*key).agg(
        *[F.max(F.when(F.col("_column") == v, F.col("_median"))).alias(v) for v in values])
