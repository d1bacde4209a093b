"""Metric, batch, quality and operation histories and the model registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.functions.columns import moment
from tillcast.models.registry import champions
from tillcast.operators.history import append_metrics, overview, tail, update_timeline
from tillcast.operators.metrics import baseline_metrics, regression_metrics
from tillcast.operators.periods import calendar
from tillcast.operators.quality import batch_metadata
from tillcast.queries.data import (
    BATCHED_SQL,
    EVENTS,
    ORDERS,
    batch_predictions,
    calendar_sql,
    fact,
    metrics_sql,
    rounded,
    split_fact,
    table,
)
from tillcast.queries.evaluation import METRICS
from tillcast.queries.registry import query

SHOWN = ("rmse", "mae", "r2", "smape", "target_mean", "prediction_mean")


def _stream_metrics(spark, folder):
    return regression_metrics(
        batch_predictions(spark, folder), by=["batch_id", "model_name"], with_range=False
    ).withColumn("period_type", F.lit("stream"))


def metric_history(spark, folder):
    """Baselines on the validation period, then three predictors on each stream batch."""
    initial, validation, _ = split_fact(spark, folder)
    first = baseline_metrics(initial, validation, "o_totalprice").withColumns(
        {"batch_id": F.lit(-1).cast("long"), "period_type": F.lit("validation")}
    )
    history = append_metrics(None, first, "rmse")
    return append_metrics(history, _stream_metrics(spark, folder), "rmse")


HISTORY_SQL = f"""{BATCHED_SQL},
    scored AS (
        SELECT batch_id, model_name, 'stream' AS period_type, {metrics_sql()} FROM batched
        GROUP BY batch_id, model_name),
    guessed AS (
        SELECT 'zero_baseline' AS model_name, o_totalprice AS actual,
            CAST(0 AS DOUBLE) AS prediction FROM placed WHERE period = 'validation'
        UNION ALL
        SELECT 'mean_baseline', o_totalprice,
            (SELECT avg(o_totalprice) FROM placed WHERE period = 'initial')
        FROM placed WHERE period = 'validation'),
    history AS (
        SELECT CAST(-1 AS BIGINT) AS batch_id, model_name, 'validation' AS period_type,
            {metrics_sql()}, min(prediction) AS prediction_min, max(prediction) AS prediction_max,
            avg(CASE WHEN actual = 0 THEN 1 ELSE 0 END) AS actual_zero_rate,
            avg(CASE WHEN prediction <= 0 THEN 1 ELSE 0 END) AS prediction_zero_rate
        FROM guessed GROUP BY model_name
        UNION ALL BY NAME
        SELECT * FROM scored),
    flagged AS (
        SELECT *, rmse = min(rmse) OVER (PARTITION BY batch_id) AS is_best_in_update
        FROM history)"""


@query(
    "metrics_history",
    f"""WITH {HISTORY_SQL}
    SELECT batch_id, model_name, period_type, is_best_in_update,
        {", ".join(f"round({c} + 1e-7, 5) AS {c}" for c in METRICS)}
    FROM flagged""",
)
def history(spark, folder):
    return rounded(metric_history(spark, folder), 5, *METRICS)


@query(
    "history_tail",
    f"""WITH {HISTORY_SQL}
    SELECT batch_id, model_name, round(rmse + 1e-7, 5) AS rmse, round(mae + 1e-7, 5) AS mae,
        round(r2 + 1e-7, 5) AS r2, is_best_in_update
    FROM flagged ORDER BY batch_id DESC, model_name DESC LIMIT 5""",
)
def last_metrics(spark, folder):
    found = tail(
        metric_history(spark, folder),
        ["batch_id", "model_name"],
        ["batch_id", "model_name", "rmse", "mae", "r2", "is_best_in_update"],
    )
    return rounded(found, 5, "rmse", "mae", "r2")


def _placed_events(spark, folder):
    events = table(spark, folder, "events")
    days = calendar(events, EVENTS).where("batch_id is not null").select("day", "batch_id")
    return events.withColumn("day", F.to_date("ts")).join(F.broadcast(days), "day").drop("day")


def operation_log(spark, folder):
    """One operation per type of event and day: purchases succeed, errors fail, the rest are reads."""
    return (
        table(spark, folder, "events")
        .groupBy(F.to_date("ts").alias("day"), "event_type")
        .agg(F.max("ts").alias("timestamp"), F.count(F.lit(1)).alias("input_rows"))
        .select(
            F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
            F.col("event_type").alias("operation"),
            F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("status"),
            "input_rows",
        )
    )


LOG_SQL = """log AS (
    SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS timestamp, event_type AS operation,
        CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status,
        count(*) AS input_rows
    FROM events GROUP BY CAST(ts AS DATE), event_type)"""


@query(
    "operations_tail",
    f"""WITH {LOG_SQL} SELECT timestamp, operation, status, input_rows FROM log
    ORDER BY timestamp DESC, operation DESC LIMIT 5""",
)
def last_operations(spark, folder):
    shown = ["timestamp", "operation", "status", "duration_seconds", "input_rows"]
    return tail(operation_log(spark, folder), ["timestamp", "operation"], shown)


@query(
    "overview",
    f"""WITH {HISTORY_SQL}, {LOG_SQL},
    {calendar_sql("events", "ts").replace("days AS", "e_days AS").replace("FROM days", "FROM e_days")
     .replace("numbered", "e_numbered").replace("sized", "e_sized").replace("split", "e_split")
     .replace("cal AS", "e_cal AS")},
    last_batch AS (
        SELECT batch_id, count(*) AS rows,
            CAST(count(*) - count(DISTINCT (event_id, ts, user_id, event_type, value, props))
                AS BIGINT) AS copies,
            sum((event_id IS NULL)::INT + (ts IS NULL)::INT + (user_id IS NULL)::INT
                + (event_type IS NULL)::INT + (value IS NULL)::INT + (props IS NULL)::INT) AS gaps
        FROM events JOIN e_cal ON e_cal.day = CAST(ts AS DATE) WHERE batch_id IS NOT NULL
        GROUP BY batch_id ORDER BY batch_id DESC LIMIT 1),
    last_metrics AS (SELECT * FROM flagged ORDER BY batch_id DESC, model_name DESC LIMIT 1),
    last_operation AS (SELECT * FROM log ORDER BY timestamp DESC, operation DESC LIMIT 1)
    SELECT 'sales_forecasting' AS project, b.batch_id AS latest_batch, b.rows,
        round(b.gaps / (b.rows * 6), 9) AS missing_part, b.copies / b.rows AS duplicate_part,
        m.model_name AS model, round(m.rmse + 1e-7, 5) AS rmse, round(m.mae + 1e-7, 5) AS mae,
        round(m.r2 + 1e-7, 5) AS r2, o.operation AS latest_operation, o.status AS latest_status
    FROM last_batch b, last_metrics m, last_operation o""",
)
def latest_state(spark, folder):
    placed = _placed_events(spark, folder)
    batches = batch_metadata(placed, EVENTS, by=["batch_id"])
    rows = placed.withColumn("row", F.struct(*[c for c in placed.columns if c != "batch_id"]))
    size = F.count(F.lit(1))
    copies = rows.groupBy("batch_id").agg(
        ((size - F.count_distinct("row")) / size).alias("duplicate_part"),
        F.lit(None).cast("double").alias("numeric_outlier_part"),
    )
    quality = batches.select("batch_id", "missing_part").join(copies, "batch_id")
    found = overview(
        ORDERS.project,
        ORDERS.model.selected,
        batches,
        quality,
        metric_history(spark, folder),
        operation_log(spark, folder),
        ["timestamp", "operation"],
    ).drop("numeric_outlier_part")
    return rounded(rounded(found, 5, "rmse", "mae", "r2"), 9, "missing_part")


def model_versions(spark, folder):
    """Per batch the predictor that did best, as the version registered with that batch."""
    best = _stream_metrics(spark, folder).groupBy("batch_id").agg(
        F.min_by("model_name", F.struct("rmse", "model_name")).alias("signature"),
        F.min("rmse").alias("rmse"),
    )
    return best.withColumn("preprocessing_version", F.lit("1"))


@query(
    "champion",
    f"""WITH RECURSIVE {HISTORY_SQL},
    versions AS (
        SELECT batch_id, arg_min(model_name, (rmse, model_name)) AS signature, min(rmse) AS rmse
        FROM scored GROUP BY batch_id),
    walk AS (
        SELECT batch_id, signature, rmse, batch_id AS best_batch_id, signature AS best_signature,
            rmse AS best_rmse FROM versions WHERE batch_id = 0
        UNION ALL
        SELECT v.batch_id, v.signature, v.rmse,
            CASE WHEN w.best_signature = v.signature AND w.best_rmse <= v.rmse
                THEN w.best_batch_id ELSE v.batch_id END,
            CASE WHEN w.best_signature = v.signature AND w.best_rmse <= v.rmse
                THEN w.best_signature ELSE v.signature END,
            CASE WHEN w.best_signature = v.signature AND w.best_rmse <= v.rmse
                THEN w.best_rmse ELSE v.rmse END
        FROM walk w JOIN versions v ON v.batch_id = w.batch_id + 1)
    SELECT batch_id, signature, round(rmse + 1e-7, 5) AS rmse, best_batch_id FROM walk""",
)
def champion(spark, folder):
    found = champions(model_versions(spark, folder), "rmse")
    return rounded(found.select("batch_id", "signature", "rmse", "best_batch_id"), 5, "rmse")


@query(
    "update_timeline",
    f"""WITH {BATCHED_SQL}, daily AS (
        SELECT day AS date, sum(actual) AS actual, sum(prediction) AS prediction
        FROM batched WHERE model_name = 'segment_mean' GROUP BY day)
    SELECT date, round(actual + 1e-7, 4) AS actual, round(prediction + 1e-7, 4) AS prediction,
        CAST(date - (SELECT min(date) FROM daily) AS INTEGER) AS day_offset FROM daily""",
)
def updates(spark, folder):
    """The segment predictor's stream batches; its history also holds a validation entry."""
    segment = batch_predictions(spark, folder).where("model_name = 'segment_mean'")
    metrics = regression_metrics(segment, by=["batch_id", "model_name"], with_range=False)
    known = metrics.withColumn("period_type", F.lit("stream")).unionByName(
        metrics.withColumns(
            {"batch_id": F.lit(-1).cast("long"), "period_type": F.lit("validation")}
        )
    )
    initial = fact(spark, folder)
    offline = initial.select(
        F.lit(-1).cast("long").alias("batch_id"),
        F.to_date(moment(initial, "o_orderdate")).alias("date"),
        F.col("o_totalprice").alias("actual"),
        F.lit("segment_mean").alias("model_name"),
        F.col("o_totalprice").alias("prediction"),
    )
    predictions = segment.withColumnRenamed("day", "date").unionByName(offline)
    return rounded(update_timeline(known, predictions), 4, "actual", "prediction")


