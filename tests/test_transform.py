import statistics

import pytest
from pyspark.sql import functions as F

from panelyard.operators.features import numeric_features
from panelyard.operators.transform import ImputeAndScale, ImputeAndScaleModel, build_transformer
from panelyard.spec import PanelSpec

SPEC = PanelSpec()
NAMES = numeric_features(SPEC)


# Prices of eleven items; the numeric columns are multiples of them.
PRICES = [3.5, 8.0, 8.0, 1.25, 40.0, 2.0, 6.5, 19.0, 0.5, 12.0, 7.75]
KINDS = ["Obra", "Obra", "Bem", "Locação", "Obra", "Bem", "Obra", "Locação", "Locação", "Bem", "Obra"]
CODES = ["31", "47", "31", "88", "05", "47", "31", "31", "12", "88", "47"]


@pytest.fixture(scope="module")
def matrix(spark):
    rows = [(n, *row) for n, row in enumerate(zip(PRICES, KINDS, CODES))]
    base = spark.createDataFrame(rows, "id long, price double, materialOuServicoNome string, classe string")
    return base.select("id", *[(F.col("price") * (k + 1)).alias(n) for k, n in enumerate(NAMES)],
                       "materialOuServicoNome", "classe")


def vectors(frame):
    return [r["features"].toArray() for r in frame.orderBy("id").collect()]


def test_categories_are_slots_in_order_and_unseen_ones_none(matrix):
    train = matrix.where("id < 7")  # four codes and three kinds; "12" and no kind come later
    rows = vectors(build_transformer(SPEC).fit(train).transform(matrix))
    kinds, codes = sorted(set(KINDS[:7])), sorted(set(CODES[:7]))
    assert {len(r) for r in rows} == {len(NAMES) + len(kinds) + len(codes)}
    for row, kind, code in zip(rows, KINDS, CODES):
        slots = row[len(NAMES):].tolist()
        assert slots == [float(kind == k) for k in kinds] + [float(code == c) for c in codes]
    assert sum(rows[8][len(NAMES):]) == 1 and CODES[8] not in codes


def test_fitted_on_train_only(matrix):
    train = PRICES[:7]
    model = build_transformer(SPEC).fit(matrix.where("id < 7")).stages[0]
    means = dict(zip(model.getInputCols(), model.getOrDefault(model.means)))
    scales = dict(zip(model.getInputCols(), model.getOrDefault(model.scales)))
    times = NAMES.index("tendencia") + 1
    assert means["tendencia"] == pytest.approx(times * statistics.fmean(train))
    assert scales["tendencia"] == pytest.approx(times * statistics.pstdev(train))


def test_missing_values_get_the_median_of_the_rest(matrix):
    name = "valor_lag_52"
    gaps = matrix.withColumn(name, F.when(~F.col("id").isin(1, 4, 9), F.col(name)))
    rows = vectors(build_transformer(SPEC).fit(gaps).transform(gaps))
    slot = NAMES.index(name)
    left = sorted(p for n, p in enumerate(PRICES) if n not in (1, 4, 9))
    middle = (left[3] + left[4]) / 2
    filled = [middle if n in (1, 4, 9) else p for n, p in enumerate(PRICES)]
    want = [(p - statistics.fmean(filled)) / statistics.pstdev(filled) for p in filled]
    assert [r[slot] for r in rows] == pytest.approx(want)


def test_column_without_values_is_left_out_and_constant_is_zero(matrix, caplog):
    odd = matrix.withColumns({"valor_lag_52": F.lit(None).cast("double"), "mes": F.lit(0.1)})
    model = build_transformer(SPEC).fit(odd)
    rows = vectors(model.transform(odd))
    assert len(rows[0]) == len(NAMES) - 1 + len(set(KINDS)) + len(set(CODES))
    assert "valor_lag_52" in caplog.text
    assert all(abs(r[NAMES.index("mes")]) < 1e-9 for r in rows)


def test_medians_of_odd_and_even_numbers_of_rows(matrix):
    for n in (10, 11):
        model = ImputeAndScale(inputCols=NAMES[:3], outputCol="n").fit(matrix.where(F.col("id") < n))
        assert model.getOrDefault(model.medians) == [k * statistics.median(PRICES[:n]) for k in (1, 2, 3)]


def test_saved_model_reads_back(matrix, tmp_path):
    model = ImputeAndScale(inputCols=NAMES[:2], outputCol="n").fit(matrix)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = ImputeAndScaleModel.load(str(tmp_path / "model"))
    assert again.transform(matrix).select("n").collect() == model.transform(matrix).select("n").collect()
