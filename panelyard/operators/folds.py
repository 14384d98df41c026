"""Temporal cross-validation folds that never cut through a period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelyard.operators.panel import PERIOD


def period_ranks(panel: DataFrame) -> DataFrame:
    """Distinct periods with their 0-based rank.

    The one unpartitioned window here runs over the calendar, never over rows
    of the panel: a century of days is 36,525 rows.
    """
    rank = F.row_number().over(Window.orderBy(PERIOD)) - 1
    return panel.select(PERIOD).distinct().withColumn("rank", rank)


def fold_periods(panel: DataFrame, n_splits: int) -> DataFrame:
    """(fold, role, period) with an expanding train and contiguous test blocks.

    With m periods every test block has ``m div (n_splits + 1)`` of them; the
    blocks end at the last period and each fold trains on all that came before.
    """
    found = panel.agg(F.count_distinct(PERIOD)).first()[0]
    if n_splits < 1 or found < n_splits + 1:
        raise ValueError(f"{n_splits} folds need at least {n_splits + 1} distinct periods, "
                         f"the panel has {found}")
    size = found // (n_splits + 1)
    starts = [found - (n_splits - fold) * size for fold in range(n_splits)]
    folds = F.array(*[F.struct(F.lit(fold).alias("fold"), F.lit(start).alias("start"))
                      for fold, start in enumerate(starts)])
    role = (F.when(F.col("rank") < F.col("start"), "train")
            .when(F.col("rank") < F.col("start") + size, "test"))
    return (period_ranks(panel).select(PERIOD, "rank", F.inline(folds))
            .select("fold", role.alias("role"), PERIOD).where(F.col("role").isNotNull()))


def temporal_folds(panel: DataFrame, n_splits: int,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """The panel's rows (or some of their columns) once per fold they are in."""
    rows = panel if columns is None else panel.select(*columns)
    return rows.join(fold_periods(panel, n_splits), PERIOD)


def fold_parts(panel: DataFrame, n_splits: int):
    """Yields (train, test) DataFrames, fold by fold."""
    periods = fold_periods(panel, n_splits)
    for fold in range(n_splits):
        yield tuple(
            panel.join(periods.where((F.col("fold") == fold) & (F.col("role") == role))
                       .select(PERIOD), PERIOD, "left_semi")
            for role in ("train", "test"))
