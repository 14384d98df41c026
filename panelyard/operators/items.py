"""Item-grain operators: dedup, typing, status filter, plausibility split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelyard.functions import scalars
from panelyard.spec import DEAD_COLUMNS, NUMERIC_COLUMNS, REASON_VALUE, PanelSpec


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column],
                  keep: str = "first") -> DataFrame:
    """One row per key: the first (or last) in ``order``; null keys are one key.

    Planned as a group limit below and above the shuffle, so a key that holds a
    large part of the table sends one row per map task, and only the columns
    used later travel.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    if keep == "last":
        columns = [c.desc_nulls_last() for c in columns]
    elif keep != "first":
        raise ValueError(f"keep must be 'first' or 'last', got {keep!r}")
    ranked = df.withColumn(
        "_nth", F.row_number().over(Window.partitionBy(*key).orderBy(*columns)))
    return ranked.where(F.col("_nth") == 1).drop("_nth")


def drop_dead_columns(df: DataFrame, names: Sequence[str] = DEAD_COLUMNS) -> DataFrame:
    return df.drop(*names)


def select_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns that exist, in the order given."""
    return df.select(*[n for n in names if n in df.columns])


def typed(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Numbers to double, the inclusion time to timestamp, class codes cleaned."""
    roles = spec.columns
    numeric = {roles.quantity, roles.unit_estimate, roles.estimated, roles.awarded,
               *NUMERIC_COLUMNS}
    changes = {n: scalars.as_double(df, n) for n in df.columns if n in numeric}
    if roles.included_at in df.columns:
        changes[roles.included_at] = scalars.as_timestamp(df, roles.included_at)
    if roles.class_code in df.columns:
        changes[roles.class_code] = scalars.identifier(F.col(roles.class_code))
    return df.withColumns(changes) if changes else df


def with_status(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows in the wanted status; a missing status is not it."""
    return df.where(F.col(spec.columns.status) == F.lit(spec.status))


def only_ids_off_status(df: DataFrame, spec: PanelSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Empties the other columns of rows that are not in the wanted status.

    Such rows take part in the dedup, where their copy may be the first, and are
    dropped after it; until then only their key, order and status have to travel.
    """
    roles = spec.columns
    wanted = F.col(roles.status) == F.lit(spec.status)
    fixed = {roles.item_id, roles.status, *keep}
    return df.withColumns({c: F.when(wanted, F.col(c)) for c in df.columns if c not in fixed})


def unique_items(raw: DataFrame, spec: PanelSpec, order: Sequence[str]) -> DataFrame:
    """Raw rows to typed items, one per id. Rows off status keep only key, order
    and status.

    The status filter comes after this on purpose: an id whose first copy is off
    status is gone even if a later copy is not.
    """
    return typed(first_per_key(slim(raw, spec, order), [spec.columns.item_id], order), spec)


def slim(raw: DataFrame, spec: PanelSpec, order: Sequence[str]) -> DataFrame:
    """What the dedup needs of raw rows and what is left of them after it."""
    return only_ids_off_status(drop_dead_columns(raw), spec, order)


def matching(df: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """Equality filters, combined; None or an empty text means no restriction."""
    tests = [F.col(name) == F.lit(value) for name, value in filters.items()
             if value is not None and value != ""]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def since(df: DataFrame, moment: str, end: Column, days: int) -> DataFrame:
    """Rows of the ``days`` days before ``end``; that day itself is not one of them."""
    return df.where((F.col(moment) >= F.date_sub(end, days)) & (F.col(moment) < end))


def flag_suspects(items: DataFrame, spec: PanelSpec) -> DataFrame:
    """Adds ``motivo``: the reason a row is implausible, null where it is not."""
    suspect = scalars.exceeds(F.col(spec.columns.awarded), spec.ceiling)
    return items.withColumn("motivo", F.when(suspect, F.lit(REASON_VALUE)))


def split_suspects(items: DataFrame, spec: PanelSpec) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined): every row is in exactly one of the two."""
    flagged = flag_suspects(items, spec)
    kept = flagged.where(F.col("motivo").isNull()).drop("motivo")
    return kept, flagged.where(F.col("motivo").isNotNull())


def positive(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(name) > 0)
