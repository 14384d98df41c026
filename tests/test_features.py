import dataclasses
import datetime
import logging

import pytest

from panelyard.operators import features, folds
from panelyard.spec import PanelSpec

SPEC = PanelSpec()
SCHEMA = ("semana date, materialOuServicoNome string, classe string, valor_total double, "
          "n_itens long, qtd_total double, qtd_mediana double, preco_unitario_mediano double, "
          "valor_estimado_total double, n_fornecedores long, n_orgaos long, taxa_desconto double")


def spend(i):
    """Awarded value of the i-th period: no two steps are alike."""
    return 7.0 * i * i + 3.0


def panel_of(spark, periods, scale=1.0):
    """Two series; the second is the first, scaled, with other counts."""
    rows = []
    for i, day in enumerate(periods):
        for kind, name, factor, n in (("Obra", "31", 1.0, 2 * i + 1), ("Locação", "47", scale, 40 - i % 40)):
            value = spend(i) * factor
            rows.append((day, kind, name, value, n, n * 1.5, 1.5, 6.0 + i, value * 1.25, n % 3 + 1, 1, 0.8))
    return spark.createDataFrame(rows, SCHEMA)


def weeks(n):
    return [datetime.date(2023, 9, 4) + datetime.timedelta(weeks=i) for i in range(n)]


def series(frame, name="31"):
    return sorted((r for r in frame.collect() if r["classe"] == name), key=lambda r: r["semana"])


def test_lags_look_backwards_within_a_series(spark):
    rows = series(features.build_features(panel_of(spark, weeks(9), scale=1e6), SPEC))
    assert [r["valor_lag_1"] for r in rows] == [None] + [spend(i) for i in range(8)]
    assert [r["itens_lag_4"] for r in rows] == [None] * 4 + [1, 3, 5, 7, 9]


def test_mean_of_the_four_periods_before(spark):
    rows = series(features.build_features(panel_of(spark, weeks(7)), SPEC))
    means = [sum(map(spend, range(i - 4, i))) / 4 for i in range(4, 7)]
    assert [r["valor_media_4"] for r in rows] == [None] * 4 + means
    assert rows[6]["itens_media_4"] == (5 + 7 + 9 + 11) / 4


def test_annual_lag_is_empty_in_a_short_panel(spark, caplog):
    made = features.build_features(panel_of(spark, weeks(8)), SPEC)
    with caplog.at_level(logging.WARNING):
        assert features.empty_annual_lags(made, SPEC) == ["valor_lag_52", "itens_lag_52"]
    assert "8 periods" in caplog.text


def test_annual_lag_fills_in_a_long_panel(spark):
    made = features.build_features(panel_of(spark, weeks(54)), SPEC)
    assert features.empty_annual_lags(made, SPEC) == []
    assert series(made)[53]["valor_lag_52"] == spend(1)


def test_calendar(spark):
    rows = series(features.build_features(panel_of(spark, [datetime.date(2024, 12, 30) + datetime.timedelta(weeks=i) for i in range(4)]), SPEC))
    assert [r["tendencia"] for r in rows] == [0, 1, 2, 3]
    assert (rows[0]["semana_do_ano"], rows[0]["mes"]) == (1, 12)
    assert all(r["sazonal_sen"] ** 2 + r["sazonal_cos"] ** 2 == pytest.approx(1) for r in rows)


def test_declared_features_exist(spark):
    made = features.build_features(panel_of(spark, weeks(2)), SPEC)
    assert set(features.numeric_features(SPEC) + features.categorical_features(SPEC)) <= set(made.columns)


def test_feature_names_follow_the_frequency():
    monthly = features.numeric_features(dataclasses.replace(SPEC, freq="M"))
    assert "valor_lag_12" in monthly and "valor_lag_52" not in monthly
    assert "valor_lag_52" in features.numeric_features(SPEC)
    quarterly = features.numeric_features(dataclasses.replace(SPEC, freq="Q"))
    assert len(quarterly) == len(set(quarterly)) == 17


def test_season_by_period_is_one_cycle_a_year(spark):
    months = [datetime.date(2025, m, 1) for m in range(1, 13)]
    made = features.build_features(panel_of(spark, months), dataclasses.replace(SPEC, freq="M"), "period")
    assert series(made)[5]["sazonal_cos"] == pytest.approx(-1)
    assert series(made)[11]["tendencia"] == 11


def test_folds(spark):
    rows = [(week, name, 1.0) for week in weeks(10) for name in "ABC"]
    frame = spark.createDataFrame(rows, "semana date, classe string, valor_total double")
    made = folds.temporal_folds(frame, 3, ["semana", "classe"]).collect()
    for fold, (low, high) in enumerate([(4, 6), (6, 8), (8, 10)]):
        train = {r["semana"] for r in made if (r["fold"], r["role"]) == (fold, "train")}
        test = [r["semana"] for r in made if (r["fold"], r["role"]) == (fold, "test")]
        assert set(test) == set(weeks(10)[low:high]) and len(test) == 3 * 2
        assert train == set(weeks(10)[:low]) and max(train) < min(test)
    parts = list(folds.fold_parts(frame, 3))
    assert [(a.count(), b.count()) for a, b in parts] == [(12, 6), (18, 6), (24, 6)]


@pytest.mark.parametrize("n", [0, 10, 20])
def test_too_many_folds(spark, n):
    frame = spark.createDataFrame([(w,) for w in weeks(10)], "semana date")
    with pytest.raises(ValueError, match="distinct periods"):
        folds.temporal_folds(frame, n)
