"""The boosted-tree family as ``pyspark.ml`` stages: an estimator and a model that pipelines save and load."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.operators.boosting import BoostParams, Forest, fit_boosted


class BoostedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (vector of both classes) and ``prediction`` (double) to rows with a features vector."""

    featuresCol = Param(Params._dummy(), "featuresCol", "features vector", TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "the trees as JSON", TypeConverters.toString)

    def __init__(self, features_col: str = "features", forest: Forest | None = None):
        super().__init__()
        self._set(featuresCol=features_col)
        if forest is not None:
            self._set(trees=json.dumps(forest.to_dict()))

    def forest(self) -> Forest:
        return Forest.from_dict(json.loads(self.getOrDefault("trees")))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sent = dataset.sparkSession.sparkContext.broadcast(self.forest())

        @F.pandas_udf("double")
        def likely(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in batches:
                margins = sent.value.margins(np.stack(x.tolist()).astype(np.float64)) if len(x) else np.zeros(0)
                yield pd.Series(1 / (1 + np.exp(-margins)))

        p = likely(vector_to_array(self.getOrDefault("featuresCol")))
        rows = dataset.withColumn("probability", array_to_vector(F.transform(
            F.array(p), lambda v: F.array(1 - v, v))[0]))
        return rows.withColumn("prediction", (vector_to_array("probability")[1] > 0.5).cast("double"))


class NewtonBooster(Estimator):
    """Fits ``BoostedTreesModel`` by second-order boosting (``operators/boosting.py``)."""

    def __init__(self, params: BoostParams, features_col: str, label_col: str, max_bins: int = 64):
        super().__init__()
        self.boost, self.features_col, self.label_col, self.max_bins = params, features_col, label_col, max_bins

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        return fit_many(dataset, [self.boost], self.features_col, self.label_col, self.max_bins)[0]


def fit_many(dataset: DataFrame, fits: list[BoostParams], features_col: str, label_col: str, max_bins: int = 64,
             weight_col: str | None = None) -> list[BoostedTreesModel]:
    """One model per parameter set, all grown over the same blocks of ``dataset`` in the same passes."""
    first = dataset.select(features_col).first()
    if first is None:
        raise ValueError("no rows to train on")
    found = fit_boosted(dataset, vector_to_array(features_col), len(first[0]), F.col(label_col),
                        F.col(weight_col) if weight_col else F.lit(1.0), fits, max_bins)
    return [BoostedTreesModel(features_col, Forest(trees, cuts)) for trees, cuts in found]
