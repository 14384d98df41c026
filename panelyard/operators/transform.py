"""The model-facing transformer. Unfitted, so that every fold fits its own."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.operators.features import categorical_features, numeric_features
from panelyard.operators.medians import exact_medians
from panelyard.session import staged
from panelyard.spec import PanelSpec

log = logging.getLogger("panelyard")


class ImputeAndScale(Estimator, HasInputCols, HasOutputCol, DefaultParamsReadable,
                     DefaultParamsWritable):
    """Fills missing numbers with the median, then scales to mean 0 and
    population deviation 1. Columns without any value are left out."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None):
        super().__init__()
        self._setDefault(outputCol="numeric")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ImputeAndScaleModel:
        names = self.getInputCols()
        # Written: the medians and the moments both read it.
        numbers = staged(dataset.select(*[F.col(n).cast("double").alias(n) for n in names]), "numbers")
        middle = exact_medians(numbers, [], names).first()
        present = [n for n in names if middle[n] is not None]
        if len(present) < len(names):
            log.warning("left out, no value to fit on: %s",
                        ", ".join(n for n in names if n not in present))
        filled = {n: F.coalesce(n, F.lit(middle[n])) for n in present}
        stats = numbers.agg(F.lit(0).alias("_"), *[
            f(c).alias(f"{tag}_{n}") for n, c in filled.items()
            for tag, f in (("mean", F.avg), ("sd", F.stddev_pop))]).first()
        means = [stats[f"mean_{n}"] for n in present]
        # A constant column has no spread to divide by, but for rounding noise.
        noise = 10 * 2.0 ** -52
        scales = [s if s > noise * abs(m) else 1.0
                  for s, m in zip([stats[f"sd_{n}"] for n in present], means)]
        model = ImputeAndScaleModel(inputCols=present, outputCol=self.getOutputCol(),
                                    medians=[middle[n] for n in present],
                                    means=means, scales=scales)
        return model


class ImputeAndScaleModel(Model, HasInputCols, HasOutputCol,
                          DefaultParamsReadable, DefaultParamsWritable):
    """Fitted by :class:`ImputeAndScale`; plain column expressions."""

    medians = Param(Params._dummy(), "medians", "fill values", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "centres", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "deviations", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, medians=None, means=None, scales=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def scaled(self) -> list:
        parts = zip(self.getInputCols(), *[self.getOrDefault(p) for p in (
            self.medians, self.means, self.scales)])
        return [(F.coalesce(F.col(n).cast("double"), F.lit(fill)) - F.lit(mean)) / F.lit(scale)
                for n, fill, mean, scale in parts]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), array_to_vector(F.array(*self.scaled())))


def one_hot_stages(columns: Sequence[str]) -> tuple[list, list[str]]:
    """Stages that give one 0/1 slot per category seen in fitting, sorted.

    A category not seen in fitting has a slot of its own that the encoder
    drops, so it comes out as all zeros.
    """
    indexed, encoded = [f"{c}_index" for c in columns], [f"{c}_onehot" for c in columns]
    indexer = StringIndexer(inputCols=list(columns), outputCols=indexed,
                            handleInvalid="keep", stringOrderType="alphabetAsc")
    encoder = OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True)
    return [indexer, encoder], encoded


def build_transformer(spec: PanelSpec) -> Pipeline:
    """An unfitted pipeline that puts the declared features into ``features``."""
    stages, encoded = one_hot_stages(categorical_features(spec))
    numeric = ImputeAndScale(inputCols=numeric_features(spec), outputCol="numeric")
    assembler = VectorAssembler(inputCols=["numeric", *encoded], outputCol="features")
    return Pipeline(stages=[numeric, *stages, assembler])
