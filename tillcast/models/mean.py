"""The mean training target as a model."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F


class ConstantModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    value = Param(Params._dummy(), "value", "the prediction", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, value=0.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("prediction", F.lit(self.getOrDefault(self.value)))


class MeanRegressor(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    def _fit(self, dataset: DataFrame) -> ConstantModel:
        return ConstantModel(value=float(dataset.agg(F.avg("label")).first()[0]))
