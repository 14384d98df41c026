"""From items to a complete period x kind x class panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.functions import scalars
from panelyard.functions.calendar import Calendar
from panelyard.operators.medians import exact_medians
from panelyard.session import staged
from panelyard.spec import NO_CLASS, OTHER_CLASSES, PanelSpec

PERIOD = "semana"
CLASS = "classe"

# What a cell without purchases holds: nothing was bought, so these are zero.
# Medians stay null, because there was no price to observe.
_ZERO_WHEN_EMPTY = ["valor_total", "n_itens", "qtd_total", "valor_estimado_total",
                    "n_fornecedores", "n_orgaos"]


def panel_key(spec: PanelSpec) -> list[str]:
    return [PERIOD, spec.columns.kind, CLASS]


def item_columns(spec: PanelSpec) -> list[str]:
    """The columns of the items a panel is made of."""
    roles = spec.columns
    return [roles.included_at, roles.kind, roles.class_code, roles.quantity, roles.unit_estimate,
            roles.estimated, roles.awarded, roles.supplier, roles.organ]


def combo_key(spec: PanelSpec) -> list[str]:
    return [spec.columns.kind, CLASS]


def class_totals(items: DataFrame, spec: PanelSpec) -> DataFrame:
    """Awarded value per class, items without a class left out."""
    code, awarded = F.col(spec.columns.class_code), F.col(spec.columns.awarded)
    return (items.where(code.isNotNull()).groupBy(code.alias("codigo"))
            .agg(scalars.money_sum(awarded, spec.sum_scale).alias("valor_total")))


def top_classes(items: DataFrame, spec: PanelSpec) -> DataFrame:
    """The N classes of the largest value; equal values go by class code."""
    return (class_totals(items, spec)
            .orderBy(F.desc("valor_total"), F.asc("codigo")).limit(spec.top_classes))


def with_reduced_class(items: DataFrame, spec: PanelSpec) -> DataFrame:
    """Adds ``classe``: a top class, the bucket of the rest, or that of no class.

    The table of top classes is written, so the optimizer knows its size and
    broadcasts it below its own limit; beyond, items are shuffled by class.
    """
    code = F.col(spec.columns.class_code)
    top = staged(top_classes(items, spec).select(F.col("codigo").alias("_top")), "top_classes")
    label = (F.when(code.isNull(), F.lit(NO_CLASS))
             .when(F.col("_top").isNotNull(), code)
             .otherwise(F.lit(OTHER_CLASSES)))
    return (items.join(top, code == F.col("_top"), "left")
            .withColumn(CLASS, label).drop("_top"))


def with_period(items: DataFrame, spec: PanelSpec) -> DataFrame:
    start = Calendar.of(spec.freq).start(F.col(spec.columns.included_at))
    return items.withColumn(PERIOD, start)


def panel_cells(items: DataFrame, spec: PanelSpec) -> DataFrame:
    """Aggregates items to the cells in which something was bought.

    ``items`` is read twice, for the top classes and to be keyed, so it should be a
    table. The keyed items are written once, narrow, for totals and medians. Items
    without a period or kind belong to no cell.
    """
    roles = spec.columns
    key = panel_key(spec)
    keyed = staged(with_period(with_reduced_class(items, spec), spec).dropna(subset=key).select(
        *key, roles.awarded, roles.quantity, roles.estimated, roles.unit_estimate, roles.supplier,
        roles.organ), "keyed_items")
    totals = keyed.groupBy(*key).agg(
        scalars.money_sum(F.col(roles.awarded), spec.sum_scale).alias("valor_total"),
        F.count(F.lit(1)).alias("n_itens"),
        scalars.money_sum(F.col(roles.quantity), spec.sum_scale).alias("qtd_total"),
        scalars.money_sum(F.col(roles.estimated), spec.sum_scale).alias("valor_estimado_total"),
        F.count_distinct(roles.supplier).alias("n_fornecedores"),
        F.count_distinct(roles.organ).alias("n_orgaos"),
    )
    middle = exact_medians(keyed, key, [roles.quantity, roles.unit_estimate])
    middle = (middle.withColumnRenamed(roles.quantity, "qtd_mediana")
              .withColumnRenamed(roles.unit_estimate, "preco_unitario_mediano"))
    return totals.join(middle, key, "left")


def complete_rectangle(cells: DataFrame, spec: PanelSpec) -> DataFrame:
    """Every observed (kind, class) pair in every period from first to last.

    ``cells`` is read three times, so it should be a table.
    """
    bounds = cells.agg(F.min(PERIOD).alias("first"), F.max(PERIOD).alias("last"))
    periods = Calendar.of(spec.freq).spine(bounds.select("first").scalar(),
                                           bounds.select("last").scalar())
    grid = (cells.select(*combo_key(spec)).distinct()
            .withColumn(PERIOD, F.explode(periods)))
    return grid.join(cells, panel_key(spec), "left").na.fill(0, _ZERO_WHEN_EMPTY)


def to_panel(items: DataFrame, spec: PanelSpec) -> DataFrame:
    """Items to the complete panel with the ratio of awarded to estimated value."""
    cells = staged(panel_cells(items, spec), "panel_cells")
    panel = complete_rectangle(cells, spec).withColumn(
        "taxa_desconto", scalars.ratio(F.col("valor_total"), F.col("valor_estimado_total")))
    return panel.select(
        *panel_key(spec), "valor_total", "n_itens", "qtd_total", "qtd_mediana",
        "preco_unitario_mediano", "valor_estimado_total", "n_fornecedores", "n_orgaos",
        "taxa_desconto")


def in_panel_order(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    return panel.orderBy(*panel_key(spec))
