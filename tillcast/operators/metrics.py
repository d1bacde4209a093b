"""Regression metrics as one-pass aggregations, baselines, improvement, leaderboard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillcast.functions.columns import CLOSE_ABSOLUTE, not_below_zero, quoted
from tillcast.functions.pearson import pearson_p_value

BASELINES = ("zero_baseline", "mean_baseline")


def metric_columns(actual: Column, prediction: Column, with_range: bool = True) -> list[Column]:
    """RMSE, MAE, R2, SMAPE and means; with the range also extremes and zero rates.

    A prediction below zero counts as zero.
    """
    p = not_below_zero(prediction)
    error = p - actual
    scale = F.abs(actual) + F.abs(p)
    squares = F.sum(error * error)
    spread = F.count(actual) * F.var_pop(actual)
    columns = [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(spread > 0, F.lit(1.0) - squares / spread)
        .otherwise(F.when(squares == 0, 1.0).otherwise(0.0))
        .alias("r2"),
        F.avg(F.when(scale != 0, 2.0 * F.abs(error) / scale).otherwise(0.0)).alias("smape"),
        F.avg(actual).alias("target_mean"),
        F.avg(p).alias("prediction_mean"),
    ]
    if with_range:
        columns += [
            F.min(p).alias("prediction_min"),
            F.max(p).alias("prediction_max"),
            F.avg((actual == 0).cast("int")).alias("actual_zero_rate"),
            F.avg((p <= 0).cast("int")).alias("prediction_zero_rate"),
        ]
    return columns


def pearson_columns(actual: Column, prediction: Column) -> list[Column]:
    """Correlation, null for fewer than two rows or a side without spread; and the row count."""
    p = not_below_zero(prediction)
    spread_y, spread_p = F.stddev_pop(actual), F.stddev_pop(p)
    defined = (
        (F.count(actual) >= 2) & (spread_y > CLOSE_ABSOLUTE) & (spread_p > CLOSE_ABSOLUTE)
    )
    # The built-in correlation fails on a side without spread, guarded or not.
    r = F.covar_pop(actual, p) / (spread_y * spread_p)
    return [
        F.when(defined, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("pearson_corr"),
        F.count(actual).alias("valid_rows"),
    ]


def regression_metrics(
    frame: DataFrame,
    actual: str = "actual",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    with_range: bool = True,
    with_pearson: bool = False,
) -> DataFrame:
    y, p = quoted(actual), quoted(prediction)
    columns = metric_columns(y, p, with_range)
    if with_pearson:
        columns += pearson_columns(y, p)
    return frame.groupBy(*by).agg(*columns)


def with_p_value(row: Mapping[str, object]) -> dict[str, object]:
    """A metric row on the driver, its p-value added."""
    made = dict(row)
    made["pearson_p_value"] = pearson_p_value(made.get("pearson_corr"), made["valid_rows"])
    return made


def mean_target(train: DataFrame, target: str) -> Column:
    """The mean training target, as a scalar subquery."""
    return train.agg(F.avg(quoted(target))).scalar()


def baseline_predictions(train: DataFrame, valid: DataFrame, target: str) -> dict[str, DataFrame]:
    """Constant predictors over the validation rows: zero, and the mean training target."""
    actual = valid.select(quoted(target).alias("actual"))
    values = (F.lit(0.0), mean_target(train, target))
    return {name: actual.withColumn("prediction", v) for name, v in zip(BASELINES, values)}


def baseline_metrics(train: DataFrame, valid: DataFrame, target: str) -> DataFrame:
    """Metric rows of both baselines from one aggregation over the validation rows."""
    rows = valid.select(
        quoted(target).alias("actual"),
        F.lit(0.0).alias(BASELINES[0]),
        mean_target(train, target).alias(BASELINES[1]),
    )
    both = [
        F.struct(F.lit(name).alias("model_name"), *metric_columns(F.col("actual"), F.col(name)))
        for name in BASELINES
    ]
    return rows.agg(F.array(*both).alias("both")).select(F.inline("both"))


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Best RMSE first; RMSE also when another metric chooses the model."""
    return metrics.orderBy("rmse", "model_name")


def best_project_model(metrics: DataFrame) -> DataFrame:
    return leaderboard(metrics.where(~F.col("model_name").isin(*BASELINES))).limit(1)


def relative_improvement(baseline: Column, candidate: Column) -> Column:
    return F.when(F.abs(baseline) <= CLOSE_ABSOLUTE, F.lit(0.0)).otherwise(
        (baseline - candidate) / baseline
    )


def improvements(metrics: DataFrame) -> DataFrame:
    """The best RMSE against each baseline's, one row."""
    best = F.min_by("model_name", F.struct("rmse", "model_name"))

    def of(name: str) -> Column:
        return F.max(F.when(F.col("model_name") == name, F.col("rmse")))

    found = metrics.agg(
        best.alias("best_model"),
        F.min("rmse").alias("best_rmse"),
        of(BASELINES[0]).alias("zero_rmse"),
        of(BASELINES[1]).alias("mean_rmse"),
    )
    return found.select(
        "best_model",
        relative_improvement(F.col("zero_rmse"), F.col("best_rmse")).alias("zero_improvement"),
        relative_improvement(F.col("mean_rmse"), F.col("best_rmse")).alias("mean_improvement"),
    )
