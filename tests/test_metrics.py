import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.functions.pearson import pearson_p_value
from tillcast.operators.diagnostics import (
    daily_timeline,
    histogram,
    metric_series,
    residuals,
    robust_range,
    scatter_sample,
)
from tillcast.operators.history import append_metrics, flag_best, overview, tail
from tillcast.operators.metrics import (
    baseline_metrics,
    baseline_predictions,
    best_project_model,
    improvements,
    leaderboard,
    regression_metrics,
    relative_improvement,
)
from tillcast.plans.fitting import score


def pairs(spark, rows):
    return spark.createDataFrame([(float(a), float(p)) for a, p in rows], "actual double, prediction double")


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    y, p = rng.uniform(0, 10, 200), rng.uniform(-3, 10, 200)
    row = regression_metrics(pairs(spark, zip(y, p)), with_pearson=True).first()
    c = np.clip(p, 0, None)
    assert row["rmse"] == pytest.approx(np.sqrt(np.mean((c - y) ** 2)))
    assert row["mae"] == pytest.approx(np.mean(np.abs(c - y)))
    assert row["r2"] == pytest.approx(1 - np.sum((y - c) ** 2) / np.sum((y - y.mean()) ** 2))
    assert row["smape"] == pytest.approx(np.mean(2 * np.abs(c - y) / (np.abs(y) + np.abs(c))))
    assert row["prediction_min"] == 0.0 and row["prediction_max"] == pytest.approx(c.max())
    assert row["prediction_zero_rate"] == pytest.approx(np.mean(c <= 0))
    assert row["pearson_corr"] == pytest.approx(np.corrcoef(y, c)[0, 1])


def test_zeros_and_constants(spark):
    row = regression_metrics(pairs(spark, [(0, 0), (0, -2), (0, 4)]), with_pearson=True).first()
    assert row["smape"] == pytest.approx(2 / 3) and row["r2"] == 0.0
    assert row["actual_zero_rate"] == 1.0 and row["pearson_corr"] is None
    assert regression_metrics(pairs(spark, [(5, 5), (5, 5)])).first()["r2"] == 1.0
    assert score(pairs(spark, [(1, 2)]))["pearson_p_value"] is None


@pytest.mark.parametrize(
    "r, n, expected",
    [
        # Textbook values: t = r sqrt((n-2)/(1-r^2)) against Student's t.
        (0.0, 10, 1.0),
        (0.632, 10, 0.0500),
        (0.878, 5, 0.0504),
        (-0.632, 10, 0.0500),
        (0.5, 3, 2 / 3),
        (0.9, 2, 1.0),
        (1.0, 10, 0.0),
    ],
)
def test_p_value(r, n, expected):
    assert pearson_p_value(r, n) == pytest.approx(expected, abs=5e-4)


def test_p_value_of_many_rows():
    assert pearson_p_value(0.01, 1_000_000) == pytest.approx(1.5e-23, rel=0.05)
    assert pearson_p_value(None, 10) is None
    # One standard error off, where the normal law holds to the last digits.
    rows = 10**12
    t = 1.0
    r = t / (rows - 2 + t * t) ** 0.5
    assert pearson_p_value(r, rows) == pytest.approx(0.31731050786, rel=1e-9)


def test_baselines_and_leaderboard(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "t double")
    valid = spark.createDataFrame([(2.0,), (4.0,)], "t double")
    found = {r["model_name"]: r for r in baseline_metrics(train, valid, "t").collect()}
    assert found["mean_baseline"]["mae"] == 1.0 and found["zero_baseline"]["mae"] == 3.0
    frames = baseline_predictions(train, valid, "t")
    assert [r["prediction"] for r in frames["mean_baseline"].collect()] == [2.0, 2.0]
    metrics = baseline_metrics(train, valid, "t").select("model_name", "rmse")
    assert best_project_model(metrics).first() is None
    metrics = metrics.union(spark.createDataFrame([("ridge", 1.0)], metrics.schema))
    assert [r["model_name"] for r in leaderboard(metrics).collect()] == [
        "ridge", "mean_baseline", "zero_baseline",
    ]
    assert best_project_model(metrics).first()["model_name"] == "ridge"
    row = improvements(metrics).first()
    assert row["best_model"] == "ridge"
    assert row["mean_improvement"] == pytest.approx(1 - 1 / np.sqrt(2))
    zero = spark.range(1).select(relative_improvement(F.lit(0.0), F.lit(3.0)).alias("v"))
    assert zero.first()["v"] == 0.0


def test_timeline(spark):
    frame = spark.sql(
        "select * from values (timestamp'2024-01-01 05:00:00', 1D, 2D), "
        "(timestamp'2024-01-01 07:00:00', 3D, 4D), (timestamp'2024-01-04 00:00:00', 5D, 6D), "
        "(timestamp'2024-01-05 00:00:00', 5D, null) as t(date, actual, prediction)"
    )
    made = [(r["day_offset"], r["actual"], r["prediction"]) for r in daily_timeline(frame).collect()]
    assert made == [(0, 4.0, 6.0), (3, 5.0, 6.0)]
    row = residuals(frame.where("prediction = 2"), "date").first()
    assert (row["date"], row["residual"]) == ("2024-01-01", -1.0)


def series(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "batch_id long, rmse double")


def bounds(spark, values):
    row = robust_range(series(spark, values), "rmse").first()
    return row["range_min"], row["range_max"]


def test_robust_range(spark):
    assert bounds(spark, [None]) == (0.0, 1.0)
    assert bounds(spark, [2.0, 2.0]) == (1.0, 3.0)
    assert bounds(spark, [0.0, 10.0]) == (-0.5, 10.5)
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 1000.0]
    low, high = np.quantile(values, [0.05, 0.95])
    padding = max((high - low) * 0.15, abs(low) * 0.02, abs(high) * 0.02, 1e-6)
    assert bounds(spark, values) == pytest.approx((1.0, min(1000.0, high + padding)))
    clipped = {r["batch_id"]: r["value"] for r in metric_series(series(spark, values)).collect()}
    assert clipped[6] == pytest.approx(min(1000.0, high + padding)) and clipped[0] == 1.0
    collapsed = [5.0] * 30 + [6.0]
    assert bounds(spark, collapsed) == pytest.approx((4.95, 6.05))


@pytest.mark.parametrize("direct_rows", [10, 10_000])
def test_histogram(spark, direct_rows):
    values = np.random.default_rng(2).normal(size=500)
    frame = spark.createDataFrame([(float(v),) for v in [*values, np.inf, np.nan]], "v double")
    made = sorted(histogram(frame, "v", direct_rows=direct_rows).collect())
    held = np.clip(values, *np.quantile(values, [0.01, 0.99]))
    counts, edges = np.histogram(held, bins=24)
    assert [r["rows"] for r in made] == list(counts)
    np.testing.assert_allclose([r["bin_low"] for r in made], edges[:-1])
    flat = histogram(spark.createDataFrame([(2.0,)] * 3, "v double"), "v").where("rows > 0")
    assert flat.first()["bin"] == 12
    assert histogram(frame.where("false"), "v").count() == 0


@pytest.mark.parametrize("one_task_rows", [0, 1_000_000])
def test_scatter_sample(spark, one_task_rows):
    frame = spark.range(2500).selectExpr("id", "double(id) as x", "double(id) as y").repartition(5)
    made = scatter_sample(frame, "x", "y", ["id"], one_task_rows=one_task_rows).collect()
    wanted = np.linspace(0, 2499, 1000).astype(int)
    assert sorted(r["id"] for r in made) == list(wanted)
    few = scatter_sample(frame.limit(10), "x", "y", ["id"])
    assert few.count() == 10


def test_history(spark):
    rows = spark.createDataFrame(
        [(0, "a", 1.0, "x"), (0, "b", 1.0, "x"), (0, "c", 2.0, "x")],
        "batch_id long, model_name string, rmse double, more string",
    )
    flagged = {r["model_name"]: r["is_best_in_update"] for r in flag_best(rows, "rmse").collect()}
    assert flagged == {"a": True, "b": True, "c": False}
    later = rows.drop("more").withColumn("batch_id", F.lit(1).cast("long"))
    history = append_metrics(append_metrics(None, rows, "rmse"), later, "rmse")
    assert history.columns == ["model_name", "batch_id", "rmse", "is_best_in_update", "more"]
    assert history.where("more is null").count() == 3
    last = tail(history, ["batch_id", "model_name"], ["model_name", "gone"], rows=2).collect()
    assert [tuple(r) for r in last] == [("b",), ("c",)]


def test_overview_of_nothing(spark):
    batches = spark.createDataFrame([], "batch_id long, rows long")
    quality = spark.createDataFrame(
        [], "batch_id long, missing_part double, duplicate_part double, numeric_outlier_part double"
    )
    metrics = spark.createDataFrame(
        [], "batch_id long, model_name string, rmse double, mae double, r2 double"
    )
    operations = spark.createDataFrame([], "timestamp string, operation string, status string")
    row = overview("p", "ridge", batches, quality, metrics, operations).first()
    assert (row["project"], row["model"], row["latest_batch"]) == ("p", "ridge", None)
