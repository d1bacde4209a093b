"""Ridge regression, and linear regression by gradient descent that can be updated.

Gradient descent on squared loss needs only the sums of x x', x y and y y. One pass over the
rows collects them; every epoch after that works on a matrix the size of the feature count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F


class RidgeRegressor(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Closed-form ridge with an unpenalised intercept and penalty ``alpha`` on the raw scale."""

    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, alpha=1.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LinearRegressionModel:
        rows, spread = dataset.agg(F.count("label"), F.stddev_pop("label")).first()
        # The library scales the squared error by 1 / (rows * spread).
        penalty = self.getOrDefault(self.alpha) * (spread or 0.0) / max(rows, 1)
        return LinearRegression(
            solver="normal", elasticNetParam=0.0, standardization=False, regParam=penalty
        ).fit(dataset)


def moments(dataset: DataFrame) -> tuple[int, np.ndarray, np.ndarray, float]:
    """Row count, sum of x x', sum of x y and sum of y y; x with a leading one."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = None
        for batch in batches:
            if batch.empty:
                continue
            x = np.column_stack([np.ones(len(batch)), np.stack(batch["x"].to_numpy())])
            y = batch["y"].to_numpy(dtype=float)
            made = np.concatenate([(x.T @ x).ravel(), x.T @ y, [y @ y]])
            sums = made if sums is None else sums + made
        if sums is not None:
            yield pd.DataFrame({"sums": [sums]})

    rows = dataset.select(vector_to_array("features").alias("x"), F.col("label").alias("y"))
    totals = (
        rows.mapInPandas(partial, "sums array<double>")
        .select(F.posexplode("sums").alias("place", "value"))
        .groupBy("place")
        .agg(F.sum("value").alias("value"))
    )
    # As many numbers as the square of the feature count.
    found = {r["place"]: r["value"] for r in totals.collect()}
    if not found:
        raise ValueError("no rows to learn from")
    flat = np.array([found[i] for i in range(len(found))])
    size = int((np.sqrt(4 * len(flat) - 3) - 1) / 2)
    gram = flat[: size * size].reshape(size, size)
    return int(round(gram[0, 0])), gram, flat[size * size : -1], float(flat[-1])


class GradientRegressor(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Gradient descent on all rows with an L2 penalty, each coordinate scaled by its curvature.

    The minimum is that of ridge with penalty alpha times the number of rows. An epoch that gains
    less than ``tol`` of the loss for five epochs in a row ends the descent.
    """

    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "epochs at most", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "least gain of an epoch, as a part of the loss", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, alpha=0.0001, maxIter=1000, tol=0.001):
        super().__init__()
        self._setDefault(alpha=0.0001, maxIter=1000, tol=0.001)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "GradientModel":
        sums = moments(dataset)
        alpha = self.getOrDefault(self.alpha)
        descent = _Descent(np.zeros(len(sums[2])), 0, alpha, sums)
        best, stale = np.inf, 0
        for _ in range(self.getOrDefault(self.maxIter)):
            loss = descent.step()
            stale = stale + 1 if loss > best * (1 - self.getOrDefault(self.tol)) else 0
            best = min(best, loss)
            if stale >= PATIENCE:
                break
        return descent.model()


# Epochs without gain that end a fit, and passes over the sums of a batch in an update.
PATIENCE = 5
UPDATE_EPOCHS = 20


class _Descent:
    """Accelerated descent on the sums of the rows; the curvature is looked at once."""

    def __init__(self, weights: np.ndarray, steps: int, alpha: float, sums):
        self.weights, self.steps, self.alpha, self.sums = weights, steps, alpha, sums
        rows, gram, _, _ = sums
        self.penalty = np.concatenate([[0.0], np.full(len(weights) - 1, alpha)])
        curvature = gram / rows + np.diag(self.penalty)
        own = np.diag(curvature)
        self.scale = np.where(own > 0, own, 1.0)
        scaled = curvature / np.sqrt(np.outer(self.scale, self.scale))
        # A step longer than the inverse of the greatest curvature would overshoot.
        self.size = 1.0 / max(float(np.linalg.eigvalsh(scaled)[-1]), 1e-12)
        self.ahead, self.pace = weights, 1.0

    def loss(self, w: np.ndarray) -> float:
        rows, gram, cross, square = self.sums
        return float(w @ gram @ w - 2 * cross @ w + square) / (2 * rows) + w @ (self.penalty * w) / 2

    def step(self) -> float:
        """One epoch; returns the loss after it."""
        rows, gram, cross, _ = self.sums
        self.steps += 1
        slope = (gram @ self.ahead - cross) / rows + self.penalty * self.ahead
        moved = self.ahead - self.size * slope / self.scale
        if slope @ (moved - self.weights) > 0:
            # Momentum leads uphill: begin anew from here.
            self.pace = 1.0
        pace = (1 + np.sqrt(1 + 4 * self.pace**2)) / 2
        self.ahead = moved + (self.pace - 1) / pace * (moved - self.weights)
        self.weights, self.pace = moved, pace
        return self.loss(moved)

    def model(self) -> "GradientModel":
        return GradientModel(
            intercept=float(self.weights[0]),
            coefficients=[float(v) for v in self.weights[1:]],
            steps=self.steps,
            alpha=self.alpha,
        )


class GradientModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)
    coefficients = Param(
        Params._dummy(), "coefficients", "coefficients", TypeConverters.toListFloat
    )
    steps = Param(Params._dummy(), "steps", "epochs so far", TypeConverters.toInt)
    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, intercept=None, coefficients=None, steps=None, alpha=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array("features")
        weights = F.array(*[F.lit(w) for w in self.getOrDefault(self.coefficients)])
        products = F.zip_with(x, weights, lambda a, b: a * b)
        total = F.aggregate(
            products, F.lit(self.getOrDefault(self.intercept)), lambda acc, v: acc + v
        )
        return dataset.withColumn("prediction", total)

    def updated(self, dataset: DataFrame) -> "GradientModel":
        """Moved on by a fixed number of passes over the sums of these rows alone."""
        weights = [self.getOrDefault(self.intercept), *self.getOrDefault(self.coefficients)]
        descent = _Descent(
            np.array(weights),
            self.getOrDefault(self.steps),
            self.getOrDefault(self.alpha),
            moments(dataset),
        )
        for _ in range(UPDATE_EPOCHS):
            descent.step()
        return descent.model()
