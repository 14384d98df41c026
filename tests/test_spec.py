from datetime import date

import pytest

from panelyard.functions.calendar import Calendar
from panelyard.spec import CollectSpec, Layers, PanelSpec, SpecError


def test_defaults():
    spec = PanelSpec.from_mapping({})
    assert (spec.freq, spec.top_classes, spec.status, spec.ceiling) == ("W", 50, "Homologado", 1e10)
    assert spec == PanelSpec()


def test_paths_derive_from_the_root():
    layers = Layers.from_mapping({"DATA_DIR": "/x"})
    assert layers.raw == "/x/raw/contract_items.csv"
    assert layers.kept == "/x/interim/itens_limpos.parquet"
    assert layers.panel == "/x/processed/painel.parquet"


@pytest.mark.parametrize("values, name", [
    ({"TOP_CLASSES": "0"}, "TOP_CLASSES"), ({"TOP_CLASSES": "x"}, "TOP_CLASSES"),
    ({"VALUE_CEILING": "0"}, "VALUE_CEILING"), ({"VALUE_CEILING": "1,5"}, "VALUE_CEILING")])
def test_bad_panel_settings(values, name):
    with pytest.raises(SpecError, match=name):
        PanelSpec.from_mapping(values)


def test_unknown_frequency():
    with pytest.raises(ValueError, match="frequency"):
        PanelSpec(freq="X")


def test_collect_settings():
    spec = CollectSpec.from_mapping({
        "END_DATE": "2025-01-31", "WINDOW_DAYS": "30", "MATERIAL_OR_SERVICE": "m", "ITEM_CLASS": " 7010 ",
        "HAS_RESULT": "", "COLUMNS": "a, b ,,c", "RESUME": "Não"}, today=date(2030, 1, 1))
    assert spec.start_date == date(2025, 1, 1)
    assert spec.filters == {"materialOuServico": "M", "codigoClasse": "7010"}
    assert spec.columns == ("a", "b", "c") and spec.resume is False
    assert CollectSpec.from_mapping({}, today=date(2030, 1, 1)).end_date == date(2030, 1, 1)


@pytest.mark.parametrize("values", [
    {"MATERIAL_OR_SERVICE": "X"}, {"WINDOW_DAYS": "0"}, {"CHUNK_DAYS": "0"}, {"RESUME": "yep"},
    {"END_DATE": "31/01/2025"}, {"TOP_ITEMS": "0"}])
def test_bad_collect_settings(values):
    with pytest.raises(SpecError):
        CollectSpec.from_mapping(values, today=date(2030, 1, 1))


def test_periods_per_year(caplog):
    assert [Calendar.of(f).periods_per_year for f in ("W", "m", "Q", "D", "W-SUN")] == [52, 12, 4, 365, 52]
    assert Calendar.of("Y").periods_per_year == 52 and "assuming 52" in caplog.text
