"""Metrics, baselines, diagnostics."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tillcast.operators.diagnostics import (
    daily_timeline,
    histogram,
    metric_series,
    residuals,
    scatter_sample,
)
from tillcast.operators.metrics import (
    baseline_metrics,
    improvements,
    leaderboard,
    regression_metrics,
)
from tillcast.operators.ranking import ONE_TASK_ROWS
from tillcast.queries.data import (
    BATCHED_SQL,
    PREDICTED_SQL,
    batch_predictions,
    metrics_sql,
    rounded,
    segment_predictions,
    split_fact,
)
from tillcast.queries.registry import query

RANGE_SQL = """min(prediction) AS prediction_min, max(prediction) AS prediction_max,
        avg(CASE WHEN actual = 0 THEN 1 ELSE 0 END) AS actual_zero_rate,
        avg(CASE WHEN prediction <= 0 THEN 1 ELSE 0 END) AS prediction_zero_rate"""
METRICS = (
    "rmse", "mae", "r2", "smape", "target_mean", "prediction_mean", "prediction_min",
    "prediction_max", "actual_zero_rate", "prediction_zero_rate",
)

BASELINE_SQL = f"""{PREDICTED_SQL},
    guessed AS (
        SELECT 'zero_baseline' AS model_name, o_totalprice AS actual,
            CAST(0 AS DOUBLE) AS prediction FROM validation
        UNION ALL
        SELECT 'mean_baseline', o_totalprice, (SELECT avg(o_totalprice) FROM initial)
        FROM validation),
    scored AS (
        SELECT model_name, {metrics_sql()}, {RANGE_SQL} FROM guessed GROUP BY model_name)"""

SEGMENT_SQL = f"""{BASELINE_SQL},
    every AS (
        SELECT * FROM scored
        UNION ALL
        SELECT 'segment_mean', {metrics_sql()}, {RANGE_SQL} FROM predicted)"""


def _rounded_sql(columns=METRICS) -> str:
    return ", ".join(f"round({c} + 1e-7, 4) AS {c}" for c in columns)


@query("baselines", f"WITH {BASELINE_SQL} SELECT model_name, {_rounded_sql()} FROM scored")
def baselines(spark, folder):
    initial, validation, _ = split_fact(spark, folder)
    found = baseline_metrics(initial, validation, "o_totalprice")
    return rounded(leaderboard(found), 4, *METRICS)


@query(
    "regression_metrics",
    f"""WITH {PREDICTED_SQL}
    SELECT {_rounded_sql()} FROM (SELECT {metrics_sql()}, {RANGE_SQL} FROM predicted)""",
)
def metrics(spark, folder):
    return rounded(regression_metrics(segment_predictions(spark, folder)), 4, *METRICS)


@query(
    "pearson",
    f"""WITH {BATCHED_SQL}
    SELECT model_name, CASE WHEN model_name = 'segment_mean'
        THEN round(corr(actual, prediction) + 1e-7, 6) END AS pearson_corr, count(*) AS valid_rows
    FROM batched GROUP BY model_name""",
)
def pearson(spark, folder):
    """Only the segment means vary, the other predictors have no correlation."""
    found = regression_metrics(
        batch_predictions(spark, folder), by=["model_name"], with_pearson=True
    )
    return rounded(found.select("model_name", "pearson_corr", "valid_rows"), 6, "pearson_corr")


def _segment_and_baselines(spark, folder):
    initial, validation, _ = split_fact(spark, folder)
    segment = regression_metrics(segment_predictions(spark, folder)).withColumn(
        "model_name", F.lit("segment_mean")
    )
    return baseline_metrics(initial, validation, "o_totalprice").unionByName(segment)


@query(
    "leaderboard",
    f"""WITH {SEGMENT_SQL}
    SELECT model_name, round(rmse + 1e-7, 4) AS rmse, row_number() OVER (ORDER BY rmse) AS place
    FROM every""",
)
def ranked(spark, folder):
    found = _segment_and_baselines(spark, folder).select("model_name", "rmse")
    # One row per model.
    place = F.row_number().over(Window.orderBy("rmse")).cast("long")
    return rounded(found.withColumn("place", place), 4, "rmse")


@query(
    "improvement",
    f"""WITH {SEGMENT_SQL}, best AS (SELECT * FROM every ORDER BY rmse LIMIT 1)
    SELECT best.model_name AS best_model,
        round((z.rmse - best.rmse) / z.rmse, 9) AS zero_improvement,
        round((m.rmse - best.rmse) / m.rmse, 9) AS mean_improvement
    FROM best, every z, every m
    WHERE z.model_name = 'zero_baseline' AND m.model_name = 'mean_baseline'""",
)
def improvement(spark, folder):
    found = improvements(_segment_and_baselines(spark, folder))
    return rounded(found, 9, "zero_improvement", "mean_improvement")


@query(
    "residuals",
    f"""WITH {PREDICTED_SQL}
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date, actual,
        round(prediction + 1e-7, 6) AS prediction, round(actual - prediction + 1e-7, 6) AS residual,
        round(ln(1 + greatest(actual, 0)), 9) AS actual_log1p,
        round(ln(1 + greatest(prediction, 0)), 9) AS prediction_log1p
    FROM predicted""",
)
def row_residuals(spark, folder):
    found = residuals(segment_predictions(spark, folder), "o_orderdate", ["o_orderkey"])
    found = rounded(found, 6, "prediction", "residual")
    return rounded(found, 9, "actual_log1p", "prediction_log1p")


@query(
    "daily_timeline",
    f"""WITH {PREDICTED_SQL}, daily AS (
        SELECT CAST(o_orderdate AS DATE) AS date, sum(actual) AS actual,
            sum(prediction) AS prediction FROM predicted GROUP BY 1)
    SELECT date, round(actual + 1e-7, 4) AS actual, round(prediction + 1e-7, 4) AS prediction,
        CAST(date - (SELECT min(date) FROM daily) AS INTEGER) AS day_offset FROM daily""",
)
def timeline(spark, folder):
    found = daily_timeline(segment_predictions(spark, folder), "o_orderdate")
    return rounded(found, 4, "actual", "prediction")


@query(
    "histogram",
    f"""WITH {PREDICTED_SQL}, rest AS (SELECT actual - prediction AS v FROM predicted),
    edge AS (
        SELECT quantile_cont(v, CAST(0.01 AS DOUBLE)) AS lo,
            quantile_cont(v, CAST(0.99 AS DOUBLE)) AS hi FROM rest),
    counted AS (
        SELECT least(CAST(floor((least(greatest(v, lo), hi) - lo) / (hi - lo) * 24) AS INTEGER),
            23) AS bin, count(*) AS rows FROM rest, edge GROUP BY 1)
    SELECT CAST(b AS INTEGER) AS bin, round(lo + b * (hi - lo) / 24 + 1e-7, 4) AS bin_low,
        round(lo + (b + 1) * (hi - lo) / 24 + 1e-7, 4) AS bin_high, coalesce(rows, 0) AS rows
    FROM range(24) AS bins(b) CROSS JOIN edge LEFT JOIN counted ON counted.bin = b""",
)
def residual_histogram(spark, folder):
    found = segment_predictions(spark, folder).select(
        (F.col("actual") - F.col("prediction")).alias("residual")
    )
    return rounded(histogram(found, "residual"), 4, "bin_low", "bin_high")


SAMPLE_SQL = f"""WITH {PREDICTED_SQL}, placed AS (
        SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position,
            count(*) OVER () AS n FROM predicted),
    wanted AS (
        SELECT DISTINCT CAST(CASE WHEN n <= 1000 THEN i WHEN i = 999 THEN n - 1
            ELSE floor(i * (CAST(n - 1 AS DOUBLE) / 999)) END AS BIGINT) AS position
        FROM (SELECT DISTINCT n FROM placed), range(1000) AS r(i))
    SELECT o_orderkey, CAST(position AS BIGINT) AS position,
        round(ln(1 + actual), 9) AS x, round(ln(1 + prediction), 9) AS y
    FROM placed SEMI JOIN wanted USING (position)"""


@query("scatter_sample_ranged", SAMPLE_SQL)
def sample_ranged(spark, folder):
    """The same with positions from a range partitioning, as for more rows than a task sorts."""
    return sample(spark, folder, one_task_rows=10)


@query("scatter_sample", SAMPLE_SQL)
def sample(spark, folder, one_task_rows=ONE_TASK_ROWS):
    found = segment_predictions(spark, folder).select(
        "o_orderkey",
        "o_orderdate",
        F.log1p("actual").alias("x"),
        F.log1p("prediction").alias("y"),
    )
    order = ["o_orderdate", "o_orderkey"]
    sampled = scatter_sample(found, "x", "y", order, one_task_rows=one_task_rows)
    return rounded(sampled.select("o_orderkey", "position", "x", "y"), 9, "x", "y")


SERIES_SQL = f"""WITH {BATCHED_SQL},
    history AS (
        SELECT batch_id, {metrics_sql()} FROM batched
        WHERE model_name = 'mean_baseline' GROUP BY batch_id),
    long AS (
        SELECT batch_id, 'rmse' AS metric, rmse AS value FROM history
        UNION ALL SELECT batch_id, 'mae', mae FROM history
        UNION ALL SELECT batch_id, 'smape', smape FROM history
        UNION ALL SELECT batch_id, 'r2', r2 FROM history),
    spread AS (
        SELECT metric, count(*) AS points, min(value) AS lo, max(value) AS hi,
            quantile_cont(value, CAST(0.05 AS DOUBLE)) AS q_lo,
            quantile_cont(value, CAST(0.95 AS DOUBLE)) AS q_hi FROM long GROUP BY metric),
    padded AS (
        SELECT *, greatest((q_hi - q_lo) * 0.15, abs(q_lo) * 0.02, abs(q_hi) * 0.02, 1e-6)
                AS pad,
            CASE WHEN abs(lo - hi) <= 1e-8 + 1e-5 * abs(hi) THEN greatest(abs(lo) * 0.1, 1)
                ELSE (hi - lo) * 0.05 END AS wide_pad FROM spread),
    chosen AS (
        SELECT *, points < 6 OR abs(q_lo - q_hi) <= 1e-8 + 1e-5 * abs(q_hi)
            OR abs(greatest(lo, q_lo - pad) - least(hi, q_hi + pad))
                <= 1e-8 + 1e-5 * abs(least(hi, q_hi + pad)) AS wide FROM padded),
    bounds AS (
        SELECT metric, CASE WHEN wide THEN lo - wide_pad ELSE greatest(lo, q_lo - pad) END AS a,
            CASE WHEN wide THEN hi + wide_pad ELSE least(hi, q_hi + pad) END AS b FROM chosen)
    SELECT batch_id, metric, round(least(greatest(value, a), b) + 1e-7, 6) AS value,
        round(a + 1e-7, 6) AS range_min, round(b + 1e-7, 6) AS range_max
    FROM long JOIN bounds USING (metric)"""


@query("robust_range", SERIES_SQL)
def series(spark, folder):
    predicted = batch_predictions(spark, folder).where("model_name = 'mean_baseline'")
    history = regression_metrics(predicted, by=["batch_id"], with_range=False)
    return rounded(metric_series(history), 6, "value", "range_min", "range_max")
