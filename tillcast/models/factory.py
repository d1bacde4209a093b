"""Estimators by name, their signature, and what a fitted model weighs most."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillcast.models.knn import KnnRegressor
from tillcast.models.linear import GradientModel, GradientRegressor, RidgeRegressor
from tillcast.models.trees import TaskForestRegressor, TaskTreeRegressor
from tillcast.params import ModelParams, canonical_model_name
from tillcast.sources.tables import records

MAX_DEPTH = 30  # the library's limit, used where no depth is set
MAX_BINS = 256  # used where no number of bins is set
# The hyperparameters each model knows.
KNOWN = {
    "knn_regression": {"n_neighbors", "weights"},
    "ridge_regression": {"alpha"},
    "sgd_regression": {"alpha", "max_iter", "tol"},
    "decision_tree_regression": {"max_depth", "min_samples_leaf", "random_state", "max_bins"},
    "random_forest_regression": {
        "n_estimators",
        "max_depth",
        "min_samples_leaf",
        "random_state",
        "max_bins",
        "bootstrap",
    },
}
# The library's bound on statistics of nodes that each task holds in a pass, kept with the models. Growing in
# tasks holds less by itself.
TREE_MEMORY_MB = 1024
FOREST_MEMORY_MB = 256


def make_estimator(name: str, hyperparameters: Mapping[str, Any], seed: int) -> Estimator:
    given = dict(hyperparameters)
    known = canonical_model_name(name)
    if known not in KNOWN:
        raise ValueError(f"unknown model: {name}")
    strange = sorted(given.keys() - KNOWN[known])
    if strange:
        raise ValueError(f"unknown hyperparameters of {known}: {', '.join(strange)}")
    if known == "knn_regression":
        return KnnRegressor(
            k=int(given.get("n_neighbors", 5)), weights=str(given.get("weights", "uniform"))
        )
    if known == "ridge_regression":
        return RidgeRegressor(alpha=float(given.get("alpha", 1.0)))
    if known == "sgd_regression":
        return GradientRegressor(
            alpha=float(given.get("alpha", 0.0001)),
            maxIter=int(given.get("max_iter", 1000)),
            tol=float(given.get("tol", 0.001)),
        )
    depth = MAX_DEPTH if given.get("max_depth") is None else int(given["max_depth"])
    if not 0 <= depth <= MAX_DEPTH:
        raise ValueError(f"max_depth must be from 0 to {MAX_DEPTH}: {depth}")
    tree = {
        "maxDepth": depth,
        "minInstancesPerNode": int(given.get("min_samples_leaf", 1)),
        "maxBins": int(given.get("max_bins", MAX_BINS)),
        "seed": int(given.get("random_state", seed)),
        "maxMemoryInMB": TREE_MEMORY_MB,
    }
    if known == "decision_tree_regression":
        return TaskTreeRegressor(**tree)
    return TaskForestRegressor(
        numTrees=int(given.get("n_estimators", 100)),
        featureSubsetStrategy="all",
        bootstrap=bool(given.get("bootstrap", True)),
        **{**tree, "maxMemoryInMB": FOREST_MEMORY_MB},
    )


def estimator_for(params: ModelParams, name: str) -> Estimator:
    return make_estimator(name, params.hyperparameters(name), params.random_seed)


def signature(params: ModelParams, name: str) -> str:
    """Model and hyperparameters as text that is equal exactly if they are."""
    made = {"model": canonical_model_name(name), "parameters": params.hyperparameters(name)}
    return json.dumps(made, sort_keys=True)


def importances(model: object, names: list[str]) -> list[tuple[str, float]] | None:
    """Feature importances, else coefficients, else nothing; nothing too if sizes differ."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif isinstance(model, GradientModel):
        values = model.getOrDefault(model.coefficients)
    elif hasattr(model, "coefficients"):
        values = model.coefficients.toArray()
    else:
        return None
    if len(values) != len(names):
        return None
    return [(name, float(value)) for name, value in zip(names, values)]


def top_features(
    spark: SparkSession, model: object, names: list[str], first: int | None = None
) -> DataFrame:
    """Features by falling absolute weight, all or the first few; none for other models."""
    rows = importances(model, names) or []
    made = records(spark, rows, "feature string, value double")
    ranked = made.withColumn("abs_value", F.abs("value"))
    if first is not None:
        return ranked.orderBy(F.desc("abs_value"), "feature").limit(first)
    return ranked.sortWithinPartitions(F.desc("abs_value"), "feature")
