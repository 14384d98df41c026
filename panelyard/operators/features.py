"""Calendar, trend, lag and rolling-mean columns. All of them look backwards."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelyard.functions.calendar import Calendar, season_angle
from panelyard.operators.panel import CLASS, PERIOD, combo_key
from panelyard.spec import PanelSpec

log = logging.getLogger("panelyard")

SHORT_LAGS = (1, 4)
MEAN_WINDOW = 4
_TARGETS = {"valor": "valor_total", "itens": "n_itens"}


def lags(spec: PanelSpec) -> list[int]:
    """The short lags and the annual one, each once."""
    return list(dict.fromkeys([*SHORT_LAGS, Calendar.of(spec.freq).periods_per_year]))


def numeric_features(spec: PanelSpec) -> list[str]:
    """Names of the numeric features, which follow the frequency."""
    # The features that every frequency has.
    fixed = ["tendencia", "semana_do_ano", "mes", "sazonal_sen", "sazonal_cos",
             "qtd_total", "qtd_mediana", "preco_unitario_mediano", "n_fornecedores",
             "n_orgaos", "taxa_desconto", "valor_media_4", "itens_media_4"]
    return fixed + [f"{short}_lag_{k}" for k in lags(spec) for short in _TARGETS]


def categorical_features(spec: PanelSpec) -> list[str]:
    return [spec.columns.kind, CLASS]


def with_calendar(panel: DataFrame, spec: PanelSpec, season: str = "iso_week") -> DataFrame:
    """Week, month and the yearly cycle as sine and cosine.

    ``iso_week`` divides the ISO week number by the periods of a year whatever
    the frequency is; ``period`` uses the place of the period in its year, one
    cycle per year for months, quarters and days too.
    """
    calendar = Calendar.of(spec.freq)
    week = F.weekofyear(PERIOD)
    if season not in ("iso_week", "period"):
        raise ValueError(f"season must be 'iso_week' or 'period', got {season!r}")
    place = week if season == "iso_week" else calendar.place_in_year(F.col(PERIOD))
    angle = season_angle(place, calendar.periods_per_year)
    return panel.withColumns({
        "semana_do_ano": week, "mes": F.month(PERIOD),
        "sazonal_sen": F.sin(angle), "sazonal_cos": F.cos(angle)})


def with_trend(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Periods since the start of the panel, from 0."""
    origin = panel.agg(F.min(PERIOD)).scalar()
    return panel.withColumn(
        "tendencia", Calendar.of(spec.freq).ordinal(F.col(PERIOD), origin))


def with_history(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Lags and means of earlier periods, within each (kind, class) series.

    The panel is a rectangle, so k rows back is k periods back. A series has one
    row per period, and all windows share one partitioning and sort.
    """
    series = Window.partitionBy(*combo_key(spec)).orderBy(PERIOD)
    before = series.rowsBetween(-MEAN_WINDOW, -1)
    columns = {}
    for short, target in _TARGETS.items():
        for k in lags(spec):
            columns[f"{short}_lag_{k}"] = F.lag(target, k).over(series)
        if target == "valor_total" and spec.sum_scale is not None:
            term = F.col(target).cast(f"decimal(28,{spec.sum_scale})")
            mean = F.sum(term).over(before).cast("double") / MEAN_WINDOW
        else:
            mean = F.avg(target).over(before)
        full = F.count(target).over(before) == MEAN_WINDOW
        columns[f"{short}_media_{MEAN_WINDOW}"] = F.when(full, mean)
    return panel.withColumns(columns)


def build_features(panel: DataFrame, spec: PanelSpec, season: str = "iso_week") -> DataFrame:
    """The panel with all feature columns. ``panel`` is read twice."""
    return with_history(with_trend(with_calendar(panel, spec, season), spec), spec)


def empty_annual_lags(features: DataFrame, spec: PanelSpec) -> list[str]:
    """Annual lags without a single value, because the panel is too short."""
    annual = Calendar.of(spec.freq).periods_per_year
    names = [f"{short}_lag_{annual}" for short in _TARGETS]
    found = features.agg(*[F.count(n).alias(n) for n in names],
                         F.count_distinct(PERIOD).alias("periods")).first()
    empty = [n for n in names if found[n] == 0]
    if empty:
        log.warning("%s hold no value: the panel has %d periods, fewer than a lag of %d needs",
                    ", ".join(empty), found["periods"], annual)
    return empty
