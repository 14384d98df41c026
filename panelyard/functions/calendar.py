"""Periods (week, month, quarter, day, year) and the fixed grid of date chunks."""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger("panelyard")

# Periods in one year, by frequency letter.
PERIODS_PER_YEAR = {"W": 52, "M": 12, "Q": 4, "D": 365}
PERIODS_PER_YEAR_DEFAULT = 52

# Fixed value: the Monday all chunk boundaries are counted from.
CHUNK_EPOCH = date(2000, 1, 3)

_UNITS = {"W": "week", "M": "month", "Q": "quarter", "D": "day", "Y": "year"}
_STEPS = {"W": "INTERVAL 7 DAYS", "M": "INTERVAL 1 MONTH", "Q": "INTERVAL 3 MONTHS",
          "D": "INTERVAL 1 DAY", "Y": "INTERVAL 1 YEAR"}
_WEEKDAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")


@dataclass(frozen=True)
class Calendar:
    """A period length; weeks may end on another day than Sunday ("W-WED")."""

    letter: str
    week_shift: int = 0

    @classmethod
    def of(cls, freq: str) -> Calendar:
        letter, _, anchor = freq.strip().upper().partition("-")
        if letter not in _UNITS or (anchor and (letter != "W" or anchor not in _WEEKDAYS)):
            raise ValueError(f"unknown period frequency {freq!r}")
        return cls(letter, (_WEEKDAYS.index(anchor) + 1) % 7 if anchor else 0)

    @property
    def periods_per_year(self) -> int:
        if self.letter not in PERIODS_PER_YEAR:
            log.warning("no period count is known for frequency %s; assuming %d a year",
                        self.letter, PERIODS_PER_YEAR_DEFAULT)
        return PERIODS_PER_YEAR.get(self.letter, PERIODS_PER_YEAR_DEFAULT)

    def start(self, moment: Column) -> Column:
        """First day of the period a moment falls into."""
        if not self.week_shift:
            return F.date_trunc(_UNITS[self.letter], moment).cast("date")
        shifted = F.date_sub(moment.cast("date"), self.week_shift)
        return F.date_add(F.date_trunc("week", shifted).cast("date"), self.week_shift)

    def spine(self, first: Column, last: Column) -> Column:
        """Array of every period start from first to last; null when there is none."""
        return F.sequence(first, last, F.expr(_STEPS[self.letter]))

    def ordinal(self, period: Column, origin: Column) -> Column:
        """Whole periods between an origin and a period start."""
        if self.letter in "WD":
            days = F.datediff(period, origin)
            return (days / (7 if self.letter == "W" else 1)).cast("int")
        months = F.months_between(period, origin)
        return (months / {"M": 1, "Q": 3, "Y": 12}[self.letter]).cast("int")

    def place_in_year(self, period: Column) -> Column:
        """1-based place of a period within its year."""
        return {"W": F.weekofyear, "M": F.month, "Q": F.quarter, "D": F.dayofyear,
                "Y": lambda _: F.lit(1)}[self.letter](period)


def season_angle(place: Column, periods: int) -> Column:
    return F.lit(2 * math.pi) * place / F.lit(periods)


def chunk_start(day: Column, chunk_days: int) -> Column:
    """The grid boundary at or before a day."""
    day = day.cast("date")
    return F.date_sub(day, F.pmod(F.datediff(day, F.lit(CHUNK_EPOCH)), F.lit(chunk_days)))


def chunk_key(start: Column, end: Column) -> Column:
    return F.concat_ws("_", start.cast("string"), end.cast("string"))


def chunk_window_offset(chunk_days: int) -> str:
    """Start offset that puts the windows of ``F.window`` on the same grid."""
    return f"{(CHUNK_EPOCH - date(1970, 1, 1)).days % chunk_days} days"


def chunk_grid(bounds: DataFrame, start: str, end: str, chunk_days: int) -> DataFrame:
    """The chunks that cover each [start, end) row of ``bounds``.

    The first chunk starts on the grid, so it may begin before ``start``, and
    the last one may run past ``end``: a superset, never a gap, with keys that
    stay the same from run to run.
    """
    first = chunk_start(F.col(start), chunk_days)
    last = F.date_sub(F.col(end).cast("date"), 1)
    starts = F.when(first <= last, F.sequence(first, last, F.expr(f"INTERVAL {chunk_days} DAYS")))
    begin = F.col("chunk_start")
    return (bounds.select(F.explode(starts).alias("chunk_start"))
            .withColumn("chunk_end", F.date_add(begin, chunk_days))
            .withColumn("chunk_key", chunk_key(begin, F.col("chunk_end"))))
