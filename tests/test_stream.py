from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql.functions import xxhash64

from tillcast.models.mean import MeanRegressor
from tillcast.operators.history import update_timeline
from tillcast.params import SOURCE_FILE, ColumnRoles, ModelParams
from tillcast.sources.files import path_exists
from tillcast.streaming.progress import MICRO_BATCH, ProgressLog
from tillcast.streaming.replay import Replay, updated_model
from tillcast.streaming.totals import DailyTotals


@pytest.fixture
def store_params(store_params):
    """Few columns, for the plans' sake; the jobs' tests have them all."""
    roles = ColumnRoles(
        numeric=("Promo",), categorical=("Store", "StoreType"), datetime=("Date",),
        service=("Customers", SOURCE_FILE),
    )
    return replace(store_params, roles=roles)


def mean_of(name):
    return MeanRegressor()


def streamed(source, workspace, files=3):
    """The rows as a stream of some files, dealt without regard to their days."""
    path = workspace.path("incoming")
    if not path_exists(workspace.spark, path):
        source.repartition(files, xxhash64("Date", "Store")).write.parquet(path)
    return lambda: workspace.spark.readStream.schema(source.schema).parquet(path)


def replay_of(source, params, workspace, make=mean_of, **more):
    return Replay(streamed(source, workspace), params, workspace, make, **more)


def committed(workspace):
    return sorted(r["batch_id"] for r in workspace.committed().collect())


def test_cursor_moves_once(store_sales, store_params, workspace):
    replay = replay_of(store_sales, store_params, workspace)
    assert replay.update(1) == 1
    assert replay.cursor() == 1 and committed(workspace) == [0]
    assert replay.update(1) == 0 and replay.cursor() == 1
    row = workspace.committed().first()
    assert (row["rows"], row["date_count"], row["initial_date_count"]) == (6, 6, 10)
    quality = workspace.quality.read().first()
    assert quality["rows"] == 6 and "StoreType" in quality["category_cardinality"]


def three_day_batches(params):
    return replace(params, model=replace(params.model, stream_batch_days=3))


def test_failure_keeps_the_cursor_and_the_landed_rows(store_sales, store_params, workspace):
    def fail(batch_id):
        raise RuntimeError("lost")

    failing = replay_of(store_sales, store_params, workspace, before_commit=fail)
    with pytest.raises(Exception, match="lost"):
        failing.update()
    assert failing.cursor() == 0 and workspace.raw.read().count() == 6
    row = workspace.operations.read().where("operation = 'update'").first()
    assert row["status"] == "failure" and "lost" in row["error_message"]
    assert replay_of(store_sales, store_params, workspace).update() == 1
    rows = workspace.operations.read().where("run_id like 'batch-0-%'").collect()
    assert sorted(r["status"] for r in rows) == ["failure", "success"]


def tables(workspace):
    found = {}
    for name in ("raw", "processed", "predictions", "batches", "quality", "metrics"):
        rows = getattr(workspace, name).read()
        kept = [c for c in sorted(rows.columns) if "path" not in c]
        found[name] = sorted(map(str, rows.select(*kept).collect()))
    return found


def test_restart_gives_what_a_clean_run_gives(spark, store_sales, store_params, workspace):
    from tillcast.plans.jobs import Workspace
    from tillcast.session import work_path

    params = three_day_batches(store_params)
    failures = [1]

    def fail_once(batch_id):
        if batch_id in failures:
            failures.remove(batch_id)
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        replay_of(store_sales, params, workspace, before_commit=fail_once).update()
    assert committed(workspace) == [0]
    assert replay_of(store_sales, params, workspace).update() == 1
    clean = Workspace(spark, work_path(spark, "clean"))
    assert replay_of(store_sales, params, clean).update() == 2
    assert tables(workspace) == tables(clean)
    model = workspace.registry(params).versions().count()
    assert model == clean.registry(params).versions().count() == 3


def test_tested_before_trained(store_sales, store_params, workspace):
    params = three_day_batches(store_params)
    replay_of(store_sales, params, workspace).update()
    rows = workspace.metrics.read().where("batch_id >= 0").orderBy("batch_id").collect()
    # Sales are 100 + day: the mean of the initial ten days, then of all days before the batch.
    assert [r["prediction_mean"] for r in rows] == pytest.approx([104.5, 108.0])
    assert [r["train_rows"] for r in rows] == [17, 20]
    daily = update_timeline(workspace.metrics.read(), workspace.predictions.read()).collect()
    assert [r["day_offset"] for r in daily] == list(range(6))
    best = workspace.registry(params).best()
    assert best["batch_id"] == -1


def test_order_and_repetition(spark, store_sales, store_params, workspace):
    params = three_day_batches(store_params)
    replay = replay_of(store_sales, params, workspace)
    assert replay.update(1) == 1
    before = tables_without_quality(workspace)
    first = spark.sql(
        "select 0L as batch_id, date'2024-01-15' as day_min, date'2024-01-17' as day_max, "
        "3L as date_count"
    ).first()
    replay.process(first)
    assert tables_without_quality(workspace) == before
    third = spark.sql(
        "select 2L as batch_id, date'2024-01-21' as day_min, date'2024-01-23' as day_max, "
        "3L as date_count"
    ).first()
    with pytest.raises(ValueError, match="out of order"):
        replay.process(third)


def tables_without_quality(workspace):
    names = ("raw", "processed", "predictions", "batches", "metrics")
    return {n: sorted(map(str, getattr(workspace, n).read().collect())) for n in names}


def test_a_refit_sees_late_rows(store_sales, store_params):
    early = store_sales.union(store_sales.where("day(Date) <> 3"))
    full = store_sales.union(store_sales)
    until = date(2024, 1, 16)
    windows = [
        updated_model(None, None, rows, until, store_params, mean_of)[1]["rows"]
        for rows in (early, full)
    ]
    assert windows == [31, 32]


def test_rolling_refit(store_sales, store_params):
    model = replace(
        store_params.model, update_strategy="rolling_refit", rolling_train_period_days=12
    )
    params = replace(store_params, model=model)
    fitted, window = updated_model(None, None, store_sales, date(2024, 1, 20), params, mean_of)
    assert (window["rows"], window["date_min"]) == (12, "2024-01-09")
    assert fitted.stages[-1].getOrDefault("value") == 113.5


def test_incremental_update_is_for_gradient_descent(store_sales, store_params, workspace):
    model = ModelParams(
        candidate_models=("sgd",), training_mode="single", update_strategy="incremental",
        stream_batch_days=3, parameters={"sgd": {"max_iter": 20}},
    )
    params = replace(store_params, model=model)
    replay = replay_of(store_sales, params, workspace, make=None)
    assert replay.update() == 2
    rows = workspace.metrics.read().where("batch_id >= 0").orderBy("batch_id").collect()
    assert [r["train_rows"] for r in rows] == [3, 3]
    wrong = replace(params, model=replace(store_params.model, update_strategy="incremental"))
    registry = workspace.registry(params)
    with pytest.raises(ValueError, match="incrementally"):
        updated_model(registry.load_current(), store_sales, store_sales, None, wrong)


def test_an_unfit_current_model_is_refused(store_sales, store_params, workspace):
    replay = replay_of(store_sales, store_params, workspace)
    replay.update(1)
    changed = replace(
        store_params, model=replace(store_params.model, parameters={"ridge": {"alpha": 9.0}})
    )
    with pytest.raises(ValueError, match="does not fit"):
        replay_of(store_sales, changed, workspace).update()


def test_empty_stream(store_sales, store_params, workspace):
    few = store_sales.withColumn("Date", store_sales["Date"].cast("timestamp_ntz"))
    rows = [
        (datetime(2024, 1, 1 + i % 3), *tuple(r)[1:]) for i, r in enumerate(few.collect())
    ]
    frame = workspace.spark.createDataFrame(rows, few.schema)
    model = replace(store_params.model, initial_train_ratio=0.9, validation_ratio=0.05)
    params = replace(store_params, model=model)
    assert replay_of(frame, params, workspace).update() == 0
    assert committed(workspace) == []


def test_files_in_any_order_give_the_same_batches(spark, store_sales, store_params, workspace):
    """Days land last first, each in a file of its own, one after the other."""
    params = three_day_batches(store_params)
    path = workspace.path("incoming")
    for n in reversed(range(1, 21)):
        store_sales.where(f"day(Date) = {n}").coalesce(1).write.mode("append").parquet(path)
    assert replay_of(store_sales, params, workspace).update() == 2
    rows = workspace.metrics.read().where("batch_id >= 0").orderBy("batch_id").collect()
    assert [r["prediction_mean"] for r in rows] == pytest.approx([104.5, 108.0])


def test_rows_that_land_late_join_the_next_refit(store_sales, store_params, workspace):
    params = three_day_batches(store_params)
    path = workspace.path("incoming")
    store_sales.write.parquet(path)
    replay = replay_of(store_sales, params, workspace)
    assert replay.update(1) == 1
    store_sales.where("day(Date) = 3").write.mode("append").parquet(path)
    assert replay.update(1) == 1
    rows = workspace.metrics.read().where("batch_id >= 0").orderBy("batch_id").collect()
    assert [r["train_rows"] for r in rows] == [17, 21]


def landing(store_sales, workspace, days):
    """Add two rows for each of some days of January to the stream's folder, as one file."""
    rows = store_sales.where(store_sales["Date"].cast("date").isin([date(2024, 1, d) for d in days]))
    rows.union(rows).coalesce(1).write.mode("append").parquet(workspace.path("incoming"))


def dealt(workspace):
    """The days of every batch, as its rows have them."""
    found = {}
    for r in workspace.raw.read().selectExpr("batch_id", "day(Date) as day").distinct().collect():
        found.setdefault(int(r["batch_id"]), set()).add(r["day"])
    return found


def stream_of(store_sales, workspace, files=None):
    options = {} if files is None else {"maxFilesPerTrigger": files}
    read = workspace.spark.readStream.schema(store_sales.schema).options(**options)
    return lambda: read.parquet(workspace.path("incoming"))


def test_days_that_land_later_extend_the_stream(store_sales, store_params, workspace):
    params = three_day_batches(store_params)
    landing(store_sales, workspace, [d for d in range(1, 12) if d != 9])
    replay = Replay(stream_of(store_sales, workspace), params, workspace, mean_of)
    # Five days, two, and three for the stream: 8, 10 and 11.
    assert replay.update() == 1 and dealt(workspace) == {0: {8, 10, 11}}
    assert replay.update() == 0
    landing(store_sales, workspace, [9, 12, 13, 14, 15, 2])
    assert replay.update() == 2
    assert dealt(workspace) == {0: {8, 10, 11}, 1: {9, 12, 13}, 2: {14, 15}}
    landing(store_sales, workspace, [16])
    assert replay.update() == 1 and dealt(workspace)[3] == {16}
    rows = workspace.committed().orderBy("batch_id").collect()
    assert {(r["initial_date_max"], r["validation_date_max"]) for r in rows} == {("2024-01-05", "2024-01-07")}
    assert [r["stream_date_count"] for r in rows] == [3, 8, 8, 9]
    metrics = workspace.metrics.read().where("batch_id >= 0").orderBy("batch_id").collect()
    # The second of January landed twice: all its rows are known.
    assert [r["train_rows"] for r in metrics] == [20, 28, 32, 34]


def test_a_short_batch_may_wait(store_sales, store_params, workspace):
    params = three_day_batches(store_params)
    landing(store_sales, workspace, range(1, 13))
    replay = Replay(stream_of(store_sales, workspace), params, workspace, mean_of)
    assert replay.update(closing=False) == 1 and dealt(workspace) == {0: {9, 10, 11}}
    landing(store_sales, workspace, [13, 14])
    assert replay.update(closing=False) == 1 and dealt(workspace)[1] == {12, 13, 14}


def test_a_planned_batch_keeps_its_days(store_sales, store_params, workspace):
    """Days that land between a batch's failure and its repetition go to the next one."""
    params = three_day_batches(store_params)
    landing(store_sales, workspace, [d for d in range(1, 14) if d != 11])

    def fail(batch_id):
        raise RuntimeError("lost")

    incoming = stream_of(store_sales, workspace)
    with pytest.raises(Exception, match="lost"):
        Replay(incoming, params, workspace, mean_of, before_commit=fail).update(1)
    landing(store_sales, workspace, [11, 14])
    assert Replay(incoming, params, workspace, mean_of).update() == 2
    assert dealt(workspace) == {0: {9, 10, 12}, 1: {11, 13, 14}}
    metrics = workspace.metrics.read().where("batch_id >= 0").orderBy("batch_id").collect()
    # Day 11 waits for batch 1, so the model after batch 0 hasn't seen it.
    assert [r["train_rows"] for r in metrics] == [22, 28]
    assert metrics[1]["prediction_mean"] == pytest.approx((sum(range(100, 110)) + 111) / 11)


def test_scored_and_learnt_inside_the_stream(store_sales, store_params, workspace):
    params = three_day_batches(store_params)
    failures = [1]

    def fail_once(batch_id):
        if batch_id in failures:
            failures.remove(batch_id)
            raise RuntimeError("lost")

    incoming = stream_of(store_sales, workspace, files=1)
    landing(store_sales, workspace, range(1, 11))
    for day in range(11, 16):
        landing(store_sales, workspace, [day])
    replay = Replay(incoming, params, workspace, mean_of, before_commit=fail_once, first_days=10)
    with pytest.raises(Exception, match="lost"):
        replay.start(availableNow=True).awaitTermination()
    assert committed(workspace) == [0]
    again = Replay(incoming, params, workspace, mean_of)
    again.start(availableNow=True).awaitTermination()
    # Five days, two, and the stream from day 8: the last two wait.
    assert dealt(workspace) == {0: {8, 9, 10}, 1: {11, 12, 13}}
    assert again.update() == 1 and dealt(workspace)[2] == {14, 15}
    rows = workspace.metrics.read().where("batch_id >= 0").orderBy("batch_id").collect()
    assert [r["prediction_mean"] for r in rows] == pytest.approx([102.0, 104.5, 106.0])
    assert again.landed.read().count() == 30


def test_a_stream_without_a_model_says_so(store_sales, store_params, workspace):
    landing(store_sales, workspace, range(1, 11))
    replay = Replay(stream_of(store_sales, workspace), store_params, workspace, mean_of)
    with pytest.raises(Exception, match="pretrain"):
        replay.start(availableNow=True).awaitTermination()


def test_totals_double_nothing(store_sales, store_params, workspace):
    params = three_day_batches(store_params)
    failing = [1]

    def fail_once(batch_id):
        if batch_id in failing:
            failing.remove(batch_id)
            raise RuntimeError("lost")

    replay = replay_of(store_sales, params, workspace, before_commit=fail_once)
    with pytest.raises(Exception, match="lost"):
        replay.update()
    DailyTotals(workspace).follow().awaitTermination()
    days = [r["date"].day for r in DailyTotals(workspace).read().orderBy("date").collect()]
    assert days == [15, 16, 17]
    for _ in range(2):
        replay.update()
        DailyTotals(workspace).follow().awaitTermination()
    kept = DailyTotals(workspace).read().orderBy("date").collect()
    daily = update_timeline(workspace.metrics.read(), workspace.predictions.read()).collect()
    assert [tuple(r)[:3] for r in kept] == [tuple(r)[:3] for r in daily] and len(kept) == 6
    assert [r["rows"] for r in kept] == [1] * 6 and [r["day_offset"] for r in kept] == list(range(6))


def test_micro_batches_are_on_record(store_sales, store_params, workspace):
    for days in ([1, 2, 3], [4], [5, 6]):
        landing(store_sales, workspace, days)
    log = ProgressLog(workspace.spark, workspace.operations)
    replay = Replay(stream_of(store_sales, workspace, 1), store_params, workspace, mean_of, progress=log)
    replay.land()
    log.close()
    told = workspace.operations.read().where(f"operation = '{MICRO_BATCH}'").orderBy("run_id").collect()
    assert [(r["run_id"], r["input_rows"]) for r in told] == [("stream-0", 6), ("stream-1", 2), ("stream-2", 4)]
    assert all(r["duration_seconds"] > 0 and r["status"] == "success" for r in told)
