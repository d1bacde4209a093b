"""What a regression model offers: any Spark ML estimator will do, a few can be updated."""

from __future__ import annotations

from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame


class FittedModel(Protocol):
    def transform(self, dataset: DataFrame) -> DataFrame:
        """Adds ``prediction`` to rows that hold ``features``."""


class RegressionEstimator(Protocol):
    def fit(self, dataset: DataFrame) -> FittedModel:
        """Learns from ``features`` and ``label``."""


@runtime_checkable
class UpdatableModel(Protocol):
    def updated(self, dataset: DataFrame) -> "UpdatableModel":
        """A model that has also learnt from these rows."""


def supports_incremental_update(model: object) -> bool:
    return isinstance(model, UpdatableModel)
