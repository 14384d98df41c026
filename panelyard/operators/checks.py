"""Invariants between stages. A broken one stops the run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.operators.panel import PERIOD, combo_key
from panelyard.spec import PanelSpec


class InvariantError(AssertionError):
    """A stage lost or invented something."""


def check_split(items: int, kept: int, quarantined: int) -> None:
    if kept + quarantined != items:
        raise InvariantError(f"the split lost rows: {items} went in, {kept + quarantined} came out")


def panel_facts(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows, periods, (kind, class) pairs and the total of a panel, one row."""
    pair = F.struct(*combo_key(spec))
    return panel.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(PERIOD).alias("n_periods"),
        F.count_distinct(pair).alias("n_combos"),
        F.coalesce(F.sum("valor_total"), F.lit(0.0)).alias("total"))


def check_panel(panel: DataFrame, expected: float, spec: PanelSpec) -> dict:
    """The panel is a rectangle and its sum is ``expected``, that of the kept items."""
    facts = panel_facts(panel, spec).first().asDict()
    if facts["n_rows"] != facts["n_periods"] * facts["n_combos"]:
        raise InvariantError(f"the panel is no rectangle: {facts}")
    if not abs(facts["total"] - expected) < 1e-6 * max(1.0, abs(expected)):
        raise InvariantError(
            f"the panel sums to {facts['total']}, the kept items to {expected}; "
            f"items without a date or kind are in no cell")
    return facts
