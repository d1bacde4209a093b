"""Replaying a stream period, with the mean of the known rows as the model where SQL checks it."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tillcast.models.mean import MeanRegressor
from tillcast.operators.periods import calendar, stream_batches
from tillcast.params import ColumnRoles, JobParams
from tillcast.plans.jobs import Workspace
from tillcast.plans.report import read_report, write_report
from tillcast.queries.data import EVENTS, calendar_sql, rounded, table
from tillcast.queries.registry import query
from tillcast.session import work_path
from tillcast.sources.tables import records
from tillcast.streaming.calendar import EPOCH
from tillcast.streaming.progress import MICRO_BATCH, ProgressLog
from tillcast.streaming.replay import Replay, updated_model
from tillcast.streaming.totals import DailyTotals

# Only the time gives features; the model under test is a mean.
TIMED = JobParams(
    time_column="ts",
    target_column="value",
    leakage_columns=(),
    roles=ColumnRoles(
        datetime=("ts",), ids=("event_id",), service=("user_id", "props", "event_type")
    ),
    model=replace(EVENTS.model, stream_batch_days=4),
)
STREAM_SQL = f"""{calendar_sql("events", "ts", 4)},
    placed AS (
        SELECT e.*, cal.day, cal.period, cal.batch_id
        FROM events e JOIN cal ON cal.day = CAST(e.ts AS DATE)),
    batches AS (
        SELECT batch_id, min(day) AS day_min, max(day) AS day_max, count(*) AS date_count
        FROM cal WHERE batch_id IS NOT NULL GROUP BY batch_id)"""


def _mean(name: str) -> MeanRegressor:
    return MeanRegressor()


def _stream_of(spark, path, schema, files=None):
    """The files of a path as a stream, so many of them to a micro-batch."""
    options = {} if files is None else {"maxFilesPerTrigger": files}
    return lambda: spark.readStream.schema(schema).options(**options).parquet(path)


def _replay(spark, folder, params=TIMED, make=_mean, path=None, files=None, **more) -> Replay:
    """A replay of the events, streamed from their own files or from a folder."""
    workspace = Workspace(spark, work_path(spark, "replay"))
    events = table(spark, folder, "events")
    # A pattern, as a stream can't be of a path that may be one file.
    path = path or f"{folder.rstrip('/')}/event[s].parquet"
    return Replay(_stream_of(spark, path, events.schema, files), params, workspace, make, **more)


def _failing_once(batches: set[int]):
    failing = set(batches)

    def fail_once(batch_id: int) -> None:
        if batch_id in failing:
            failing.discard(batch_id)
            raise RuntimeError("executor gone")

    return fail_once


def _update_through_failure(replay: Replay) -> None:
    try:
        replay.update()
    except RuntimeError as problem:
        if "executor gone" not in str(problem):
            raise
    replay.update()


@query(
    "stream_replay",
    f"""WITH {STREAM_SQL}
    SELECT batch_id, 'stream' AS period_type, count(*) AS rows,
        strftime(min(day), '%Y-%m-%d') AS date_min, strftime(max(day), '%Y-%m-%d') AS date_max,
        count(DISTINCT day) AS date_count, round(avg(value) + 1e-7, 6) AS target_mean,
        (SELECT strftime(min(day), '%Y-%m-%d') FROM cal WHERE period = 'stream')
            AS stream_date_min,
        (SELECT count(*) FROM cal WHERE period = 'stream') AS stream_date_count
    FROM placed WHERE batch_id IS NOT NULL GROUP BY batch_id""",
)
def stream_replay(spark, folder):
    """The committed batches of a whole replay."""
    replay = _replay(spark, folder)
    replay.update()
    shown = ("batch_id", "period_type", "rows", "date_min", "date_max", "date_count")
    return rounded(
        replay.workspace.committed().select(
            *shown, "target_mean", "stream_date_min", "stream_date_count"
        ),
        6,
        "target_mean",
    )


@query(
    "stream_commit",
    f"""WITH {STREAM_SQL}
    SELECT t AS "table", batch_id, CASE WHEN t IN ('raw', 'processed', 'predictions')
        THEN count(*) ELSE 1 END AS rows
    FROM placed, (VALUES ('raw'), ('processed'), ('predictions'), ('batches'), ('metrics'),
        ('quality')) AS names(t)
    WHERE batch_id IS NOT NULL GROUP BY t, batch_id""",
)
def stream_commit(spark, folder):
    """Batch 1 fails before its commit and is run again: every table holds each batch once."""
    replay = _replay(spark, folder, before_commit=_failing_once({1}))
    _update_through_failure(replay)
    space = replay.workspace
    tables = {
        "raw": space.raw,
        "processed": space.processed,
        "predictions": space.predictions,
        "batches": space.batches,
        "metrics": space.metrics,
        "quality": space.quality,
    }
    counts = [
        found.read().where("batch_id >= 0").groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table"), F.col("batch_id").cast("long"), "rows")
        for name, found in tables.items()
    ]
    made = counts[0]
    for more in counts[1:]:
        made = made.unionByName(more)
    return made


@query(
    "prequential",
    f"""WITH {STREAM_SQL},
    models AS (
        SELECT b.batch_id, CASE WHEN b.batch_id = 0
            THEN (SELECT avg(value) FROM placed WHERE period = 'initial')
            ELSE (SELECT avg(value) FROM placed p WHERE p.day < b.day_min) END AS prediction,
            (SELECT count(*) FROM placed p WHERE p.day <= b.day_max) AS train_rows
        FROM batches b),
    scored AS (
        SELECT p.batch_id, p.value AS actual, m.prediction, m.train_rows
        FROM placed p JOIN models m ON m.batch_id = p.batch_id)
    SELECT batch_id, train_rows, count(*) AS valid_rows, {", ".join(
        f"round({c} + 1e-7, 6) AS {c}" for c in ("rmse", "mae", "smape", "prediction_mean"))}
    FROM (SELECT batch_id, train_rows, actual, {", ".join((
        "sqrt(avg((prediction - actual) * (prediction - actual)) OVER w) AS rmse",
        "avg(abs(prediction - actual)) OVER w AS mae",
        "avg(2 * abs(prediction - actual) / (abs(actual) + abs(prediction))) OVER w AS smape",
        "prediction AS prediction_mean"))}
        FROM scored WINDOW w AS (PARTITION BY batch_id))
    GROUP BY ALL""",
)
def prequential(spark, folder):
    """Each batch scored by the model from before it, full refit after it."""
    replay = _replay(spark, folder)
    replay.update()
    found = replay.workspace.metrics.read().where("period_type = 'stream'")
    shown = ("rmse", "mae", "smape", "prediction_mean")
    return rounded(
        found.select(F.col("batch_id").cast("long"), "train_rows", "valid_rows", *shown), 6, *shown
    )


def _refits(spark, folder, params):
    """The model and training window after each batch, without a stream."""
    events = table(spark, folder, "events")
    batches = stream_batches(calendar(events, params)).orderBy("batch_id").collect()
    rows = []
    for batch in batches:
        model, window = updated_model(None, None, events, batch["day_max"], params, _mean)
        value = model.stages[-1].getOrDefault("value")
        rows.append(
            (batch["batch_id"], window["rows"], window["date_min"], window["date_max"], value)
        )
    schema = "batch_id long, train_rows long, date_min string, date_max string, value double"
    made = records(spark, rows, schema)
    return rounded(made, 6, "value")


def _refit_sql(condition: str) -> str:
    return f"""WITH {STREAM_SQL}
    SELECT b.batch_id, count(*) AS train_rows, strftime(min(p.day), '%Y-%m-%d') AS date_min,
        strftime(max(p.day), '%Y-%m-%d') AS date_max, round(avg(p.value) + 1e-7, 6) AS value
    FROM batches b JOIN placed p ON {condition} GROUP BY b.batch_id"""


@query("refit_full", _refit_sql("p.day <= b.day_max"))
def refit_full(spark, folder):
    return _refits(spark, folder, TIMED)


@query("refit_rolling", _refit_sql("p.day <= b.day_max AND p.day >= b.day_max - 9"))
def refit_rolling(spark, folder):
    model = replace(TIMED.model, update_strategy="rolling_refit", rolling_train_period_days=10)
    return _refits(spark, folder, replace(TIMED, model=model))


@query("sgd_update")
def sgd_update(spark, folder):
    """Incremental updates of a linear model, batch by batch, with a frozen preprocessor."""
    model = replace(
        EVENTS.model, selected_model="sgd", update_strategy="incremental", stream_batch_days=5
    )
    replay = _replay(spark, folder, replace(EVENTS, model=model), make=None)
    replay.update()
    return replay.workspace.metrics.read().select(
        "batch_id", "model_name", "period_type", "rmse", "mae", "train_rows", "valid_rows"
    )


LATE_SQL = "day < (SELECT min(day_min) FROM batches) AND event_id % 7 = 0"


@query(
    "late_rows",
    f"""WITH {STREAM_SQL}
    SELECT b.batch_id, count(*) AS train_rows, round(avg(p.value) + 1e-7, 6) AS value
    FROM batches b JOIN placed p ON p.day <= b.day_max
        AND (b.batch_id > 0 OR NOT ({LATE_SQL.replace("day <", "p.day <")}))
    WHERE b.batch_id <= 1 GROUP BY b.batch_id""",
)
def late_rows(spark, folder):
    """Rows of early days that land after batch 0 are part of the refit after batch 1."""
    events = table(spark, folder, "events")
    first = stream_batches(calendar(events, TIMED)).agg(F.min("day_min")).first()[0]
    late = (F.to_date("ts") < F.lit(first)) & (F.col("event_id") % 7 == 0)
    path = work_path(spark, "landing")
    events.where(~late).write.parquet(path)
    replay = _replay(spark, folder, path=path)
    replay.update(1)
    events.where(late).write.mode("append").parquet(path)
    replay.update(1)
    registry = replay.workspace.registry(TIMED)
    found = replay.workspace.metrics.read().where("period_type = 'stream'")
    rows = [
        (r["batch_id"], r["train_rows"], _value(registry, r["batch_id"]))
        for r in found.select(F.col("batch_id").cast("long"), "train_rows").collect()
    ]
    made = records(spark, rows, "batch_id long, train_rows long, value double")
    return rounded(made, 6, "value")


def _value(registry, batch_id: int) -> float:
    version = registry.versions().where(F.col("batch_id") == batch_id).first()
    return registry.load(version, "stored").stages[-1].getOrDefault("value")


@query(
    "retried_operations",
    f"""WITH {STREAM_SQL}, last AS (SELECT max(batch_id) AS last_id FROM batches)
    SELECT batch_id, status, CAST(1 AS BIGINT) AS attempts
    FROM (SELECT batch_id, 'success' AS status FROM batches
        UNION ALL SELECT 1, 'failure' FROM last WHERE last_id >= 1)""",
)
def retried_operations(spark, folder):
    """The operations of a replay whose batch 1 fails once: the failure stays on record."""
    replay = _replay(spark, folder, before_commit=_failing_once({1}))
    _update_through_failure(replay)
    batch = F.regexp_extract("run_id", "^batch-(\\d+)-", 1)
    found = replay.workspace.operations.read().where("operation = 'update' AND run_id LIKE 'batch-%'")
    return found.groupBy(batch.cast("long").alias("batch_id"), "status").agg(
        F.count(F.lit(1)).alias("attempts")
    )


def _portion_sql(size: int, held_back: str = "") -> str:
    """The calendar of the first three fifths of the days, all days, and where the stream begins."""
    return f"""every_day AS (
        SELECT day, CAST(row_number() OVER (ORDER BY day) - 1 AS BIGINT) AS place,
            count(*) OVER () * 3 // 5 AS early
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)),
    portion AS (SELECT day FROM every_day WHERE place < early {held_back}),
    {calendar_sql("portion", "day", size)},
    start AS (SELECT max(day) AS until FROM cal WHERE period = 'validation')"""


def _portions(spark, folder, held_back=False):
    """The events of the first three fifths of the days, all but one of these if one is held back, and the rest."""
    events = table(spark, folder, "events")
    days = [r["day"] for r in calendar(events, TIMED).orderBy("ord").select("day").collect()]
    early = days[: len(days) * 3 // 5]
    if held_back:
        early.pop(-3)
    first = F.to_date("ts").isin(early)
    return events.where(first), events.where(~first), [d for d in days if d not in early]


@query(
    "stream_portions",
    f"""WITH {_portion_sql(4, "AND place <> early - 3")},
    later AS (
        SELECT day, CAST(row_number() OVER (ORDER BY day) - 1 AS BIGINT) AS place FROM every_day
        WHERE day > (SELECT until FROM start) AND day NOT IN (SELECT day FROM portion)),
    planned AS (
        SELECT day, batch_id FROM cal WHERE batch_id IS NOT NULL
        UNION ALL
        SELECT day, (SELECT max(batch_id) + 1 FROM cal) + place // 4 FROM later),
    sizes AS (SELECT CAST(ts AS DATE) AS day, count(*) AS rows FROM events GROUP BY 1)
    SELECT p.batch_id, p.day, s.rows,
        (SELECT CAST(sum(rows) AS BIGINT) FROM sizes
            WHERE day <= (SELECT until FROM start)
                OR day IN (SELECT q.day FROM planned q WHERE q.batch_id <= p.batch_id)) AS train_rows
    FROM planned p JOIN sizes s USING (day)""",
)
def stream_portions(spark, folder):
    """Days land in two portions, one of the first's days only with the second: each is in one batch."""
    first, second, _ = _portions(spark, folder, held_back=True)
    path = work_path(spark, "landing")
    first.write.parquet(path)
    replay = _replay(spark, folder, path=path)
    replay.update()
    second.write.mode("append").parquet(path)
    replay.update()
    space = replay.workspace
    days = space.raw.read().groupBy(
        F.col("batch_id").cast("long").alias("batch_id"), F.to_date("ts").alias("day")
    )
    trained = space.metrics.read().where("period_type = 'stream'").select("batch_id", "train_rows")
    return days.agg(F.count(F.lit(1)).alias("rows")).join(trained, "batch_id")


INSIDE = replace(TIMED, model=replace(TIMED.model, stream_batch_days=5))


@query(
    "prequential_stream",
    f"""WITH {_portion_sql(5)},
    planned AS (
        SELECT day, CAST((row_number() OVER (ORDER BY day) - 1) // 5 AS BIGINT) AS batch_id
        FROM every_day WHERE day > (SELECT until FROM start)),
    placed AS (
        SELECT e.value, CAST(e.ts AS DATE) AS day, p.batch_id
        FROM events e LEFT JOIN planned p ON p.day = CAST(e.ts AS DATE)),
    models AS (
        SELECT b.batch_id, CASE WHEN b.batch_id = 0 THEN (SELECT avg(value) FROM placed
                WHERE day <= (SELECT max(day) FROM cal WHERE period = 'initial'))
            ELSE (SELECT avg(value) FROM placed WHERE day < b.day_min) END AS prediction,
            (SELECT count(*) FROM placed WHERE day <= b.day_max) AS train_rows
        FROM (SELECT batch_id, min(day) AS day_min, max(day) AS day_max FROM planned
            GROUP BY batch_id) b)
    SELECT p.batch_id, m.train_rows, count(*) AS valid_rows,
        round(sqrt(avg((m.prediction - p.value) * (m.prediction - p.value))) + 1e-7, 6) AS rmse,
        round(avg(abs(m.prediction - p.value)) + 1e-7, 6) AS mae,
        round(any_value(m.prediction) + 1e-7, 6) AS prediction_mean
    FROM placed p JOIN models m USING (batch_id) GROUP BY p.batch_id, m.train_rows""",
)
def prequential_stream(spark, folder):
    """Scored and learnt from inside a running stream of days, which stops between two batches once."""
    first, second, days = _portions(spark, folder)
    path = work_path(spark, "landing")
    first.coalesce(1).write.parquet(path)
    replay = _replay(spark, folder, INSIDE, path=path, files=1, before_commit=_failing_once({1}))
    replay.update(0)
    for day in days:
        second.where(F.to_date("ts") == F.lit(day)).coalesce(1).write.mode("append").parquet(path)
    for _ in range(2):
        try:
            replay.start(availableNow=True).awaitTermination()
        except StreamingQueryException as problem:
            if "executor gone" not in str(problem):
                raise
    replay.update()
    found = replay.workspace.metrics.read().where("period_type = 'stream'")
    shown = ("rmse", "mae", "prediction_mean")
    return rounded(
        found.select(F.col("batch_id").cast("long"), "train_rows", "valid_rows", *shown), 6, *shown
    )


@query(
    "totals_stream",
    f"""WITH {STREAM_SQL},
    models AS (
        SELECT b.batch_id, CASE WHEN b.batch_id = 0
            THEN (SELECT avg(value) FROM placed WHERE period = 'initial')
            ELSE (SELECT avg(value) FROM placed p WHERE p.day < b.day_min) END AS prediction
        FROM batches b)
    SELECT p.day AS date, round(sum(p.value) + 1e-7, 4) AS actual,
        round(sum(m.prediction) + 1e-7, 4) AS prediction, count(*) AS rows,
        CAST(p.day - (SELECT min(day_min) FROM batches) AS INTEGER) AS day_offset
    FROM placed p JOIN models m USING (batch_id) GROUP BY p.day""",
)
def totals_stream(spark, folder):
    """Daily totals kept by a stream over the predictions; one batch's are written twice."""
    replay = _replay(spark, folder, before_commit=_failing_once({1}))
    totals = DailyTotals(replay.workspace)
    try:
        replay.update()
    except RuntimeError as problem:
        if "executor gone" not in str(problem):
            raise
    totals.follow().awaitTermination()
    replay.update()
    totals.follow().awaitTermination()
    return rounded(totals.read(), 4, "actual", "prediction")


@query(
    "micro_batches",
    """WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
    files AS (SELECT day, (row_number() OVER (ORDER BY day) - 1) // 5 AS file FROM days)
    SELECT CAST(file AS BIGINT) AS epoch, count(*) AS input_rows, count(*) AS landed_rows,
        'success' AS status
    FROM events JOIN files ON files.day = CAST(ts AS DATE) GROUP BY file""",
)
def micro_batches(spark, folder):
    """What the stream reports of its micro-batches, beside the rows each one landed."""
    events = table(spark, folder, "events")
    days = [r["day"] for r in calendar(events, TIMED).orderBy("ord").select("day").collect()]
    path = work_path(spark, "landing")
    for at in range(0, len(days), 5):
        of = F.to_date("ts").isin(days[at : at + 5])
        events.where(of).coalesce(1).write.mode("append").parquet(path)
    replay = _replay(spark, folder, path=path, files=1)
    replay.progress = ProgressLog(spark, replay.workspace.operations)
    replay.land()
    replay.progress.close()
    told = replay.workspace.operations.read().where(F.col("operation") == MICRO_BATCH)
    epoch = F.regexp_extract("run_id", r"^stream-(\d+)$", 1).cast("long").alias("epoch")
    landed = replay.landed.read().groupBy(F.col(EPOCH).cast("long").alias("epoch"))
    return told.select(epoch, "input_rows", "status").join(
        landed.agg(F.count(F.lit(1)).alias("landed_rows")), "epoch"
    )


REPORTED = replace(
    TIMED,
    roles=replace(TIMED.roles, categorical=("event_type",), service=("user_id", "props")),
    model=replace(TIMED.model, stream_batch_days=6),
)


@query(
    "workspace_report",
    f"""WITH {STREAM_SQL.replace("// 4", "// 6")},
    models AS (
        SELECT b.batch_id, CASE WHEN b.batch_id = 0
            THEN (SELECT avg(value) FROM placed WHERE period = 'initial')
            ELSE (SELECT avg(value) FROM placed p WHERE p.day < b.day_min) END AS prediction
        FROM batches b),
    scored AS (
        SELECT p.batch_id, p.day, p.value, m.prediction FROM placed p JOIN models m USING (batch_id)
        UNION ALL
        SELECT -1, day, value, (SELECT avg(value) FROM placed WHERE period = 'initial')
        FROM placed WHERE period = 'validation'),
    errors AS (
        SELECT batch_id, count(*) AS rows,
            sqrt(avg((prediction - value) * (prediction - value))) AS rmse
        FROM scored GROUP BY batch_id),
    stream AS (SELECT * FROM scored WHERE batch_id >= 0),
    parts AS (
        SELECT 'overview' AS part, 1 AS rows, (SELECT arg_max(rmse, batch_id) FROM errors) AS value
        UNION ALL SELECT 'metrics', count(*), sum(rmse)
            FROM (SELECT * FROM errors ORDER BY batch_id DESC LIMIT 5)
        UNION ALL SELECT 'batches', count(*), sum(rows) FROM (
            SELECT * FROM errors WHERE batch_id >= 0 ORDER BY batch_id DESC LIMIT 5)
        UNION ALL SELECT 'quality', count(*), sum(rows) FROM (
            SELECT * FROM errors WHERE batch_id >= 0 ORDER BY batch_id DESC LIMIT 5)
        UNION ALL SELECT 'timeline', count(DISTINCT day), sum(prediction) FROM stream
        UNION ALL SELECT 'series', 4 * count(*), NULL FROM errors
        UNION ALL SELECT 'residuals', 24, count(*) FROM stream
        UNION ALL SELECT 'sample', least(count(*), 1000), NULL FROM stream
        UNION ALL SELECT 'features', 0, NULL
        UNION ALL SELECT 'categories', 1, (SELECT count(DISTINCT event_type) FROM placed
            WHERE batch_id IS NOT NULL))
    SELECT part, CAST(rows AS BIGINT) AS rows, round(CAST(value AS DOUBLE) + 1e-7, 4) AS value FROM parts""",
)
def workspace_report(spark, folder):
    """Rows and a total of every part of the report on what a replay has left."""
    replay = _replay(spark, folder, REPORTED)
    replay.update()
    write_report(replay.workspace, REPORTED)
    totals = {
        "overview": "rmse", "metrics": "rmse", "batches": "rows", "quality": "rows",
        "timeline": "prediction", "series": None, "residuals": "rows", "sample": None,
        "features": None, "categories": "unique_values",
    }
    parts = []
    for name, column in totals.items():
        value = F.lit(None) if column is None else F.sum(column)
        parts.append(
            read_report(replay.workspace, name).agg(
                F.count(F.lit(1)).alias("rows"), value.cast("double").alias("value")
            ).select(F.lit(name).alias("part"), "rows", "value")
        )
    return rounded(reduce(lambda a, b: a.unionByName(b), parts), 4, "value")
