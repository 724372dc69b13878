"""Logistic regression of ``operators/logistic.py`` as ``pyspark.ml`` stages."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.operators.logistic import LogisticParams, fit_logistic


class LogisticNewtonModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (vector of both classes) and ``prediction`` (double); Spark expressions only."""

    featuresCol = Param(Params._dummy(), "featuresCol", "features vector", TypeConverters.toString)
    coefficients = Param(Params._dummy(), "coefficients", "one per feature", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)

    def __init__(self, features_col: str = "features", solution: np.ndarray | None = None):
        super().__init__()
        self._set(featuresCol=features_col)
        if solution is not None:
            self._set(coefficients=[float(c) for c in solution[:-1]], intercept=float(solution[-1]))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(self.getOrDefault("featuresCol"))
        terms = F.zip_with(x, F.array(*[F.lit(c) for c in self.getOrDefault("coefficients")]), lambda a, b: a * b)
        margin = F.aggregate(terms, F.lit(self.getOrDefault("intercept")), lambda total, t: total + t)
        p = F.transform(F.array(1 / (1 + F.exp(-margin))), lambda v: F.array(1 - v, v))[0]
        rows = dataset.withColumn("probability", array_to_vector(p))
        return rows.withColumn("prediction", (vector_to_array("probability")[1] > 0.5).cast("double"))


class LogisticNewton(Estimator):
    def __init__(self, params: LogisticParams, features_col: str, label_col: str):
        super().__init__()
        self.logistic, self.features_col, self.label_col = params, features_col, label_col

    def _fit(self, dataset: DataFrame) -> LogisticNewtonModel:
        return fit_many(dataset, [self.logistic], self.features_col, self.label_col)[0]


def fit_many(dataset: DataFrame, fits: list[LogisticParams], features_col: str, label_col: str) -> list[LogisticNewtonModel]:
    """One model per parameter set, all solved over the same blocks of ``dataset`` in the same passes."""
    first = dataset.select(features_col).first()
    if first is None:
        raise ValueError("no rows to train on")
    solved = fit_logistic(dataset, vector_to_array(features_col), len(first[0]), F.col(label_col), fits)
    return [LogisticNewtonModel(features_col, w) for w in solved]
