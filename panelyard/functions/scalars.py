"""Scalar column expressions. All of them stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts a CSV cell may hold that mean "missing".
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# A bare cast would also take Java suffixes ("10d") and hexadecimal floats.
_JAVA_ONLY = r"[dDfFxX]"
_INFINITY = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def missing_to_null(column: Column, tokens: tuple[str, ...] = MISSING_TOKENS) -> Column:
    return F.when(~column.isin(*tokens), column)


def text_to_double(column: Column) -> Column:
    """Text to double; whatever is not a number becomes null."""
    value = column.try_cast("double")
    plain = ~column.rlike(_JAVA_ONLY) | column.rlike(_INFINITY)
    return F.when(plain & ~F.isnan(value), value)


def as_double(df: DataFrame, name: str) -> Column:
    """The column as double with null, never NaN, for missing."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return text_to_double(F.col(name))
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value) if isinstance(kind, T.FractionalType) else value


def as_timestamp(df: DataFrame, name: str) -> Column:
    """The column as timestamp; text that is no date-time becomes null. Columns
    that are timestamps already are left alone, so filters on them still reach
    the scan."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return column
    return F.try_to_timestamp(column) if isinstance(kind, T.StringType) else column.cast("timestamp")


def identifier(column: Column) -> Column:
    """Class codes arrive written as floats ("7010.0") but are identifiers."""
    return F.regexp_replace(column.cast("string"), r"\.0$", "")


def or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0.0))


def exceeds(column: Column, limit: float) -> Column:
    """Strictly above the limit; a missing value never is."""
    return F.coalesce(column > F.lit(limit), F.lit(False))


def ratio(numerator: Column, denominator: Column) -> Column:
    """A ratio that is null where the denominator is zero or missing."""
    return F.try_divide(numerator, denominator)


def short_text(column: Column, length: int = 70) -> Column:
    return F.substring(column, 1, length)


def billions(column: Column) -> Column:
    return column / F.lit(1e9)


def brazilian_number(column: Column, decimals: int = 0) -> Column:
    """1234567.89 -> "1.234.567,89"."""
    return F.translate(F.format_number(column, decimals), ",.", ".,")


def money_sum(column: Column, scale: int | None) -> Column:
    """Sum of a money column, 0 where there is nothing to add.

    With a scale the terms are added as decimals, so the total does not depend
    on the order in which partitions are merged.
    """
    if scale is None:
        return or_zero(F.sum(column))
    return or_zero(F.sum(column.cast(f"decimal({18 + max(0, scale - 4)},{scale})")).cast("double"))
