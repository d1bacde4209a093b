from datetime import date, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillcast.operators.periods import (
    boundaries,
    calendar,
    known_rows,
    period_rows,
    rolling_rows,
    rows_for_days,
    split_periods,
    stream_batches,
    window_metadata,
)
from tillcast.params import JobParams, ModelParams


def dated(spark, offsets):
    rows = [(datetime(2024, 1, 1, i % 24) + timedelta(days=o),) for i, o in enumerate(offsets)]
    return spark.createDataFrame(rows, "Date timestamp_ntz")


def with_model(**settings_):
    return JobParams(model=ModelParams(**settings_))


def test_twenty_days(spark, store_sales):
    params = JobParams()
    split = split_periods(store_sales, params)
    assert [split.days(p) for p in ("initial", "validation", "stream")] == [10, 4, 6]
    assert split.first("validation") == date(2024, 1, 11)
    assert split.last("stream") == date(2024, 1, 20)
    batches = stream_batches(calendar(store_sales, params)).collect()
    assert [(b["batch_id"], b["date_count"]) for b in batches] == [(0, 6)]
    assert period_rows(store_sales, params, split, "stream").count() == 6


def test_batches_count_present_days(spark):
    frame = dated(spark, [0, 1, 2, 3, 10, 20, 30, 40, 50, 60])
    batches = stream_batches(calendar(frame, with_model(stream_batch_days=2)))
    found = [(b["day_min"], b["day_max"]) for b in batches.orderBy("batch_id").collect()]
    assert found == [(date(2024, 2, 10), date(2024, 2, 20)), (date(2024, 3, 1), date(2024, 3, 1))]


def test_empty_stream(spark):
    params = with_model(initial_train_ratio=0.9, validation_ratio=0.05)
    split = split_periods(dated(spark, [0, 1, 2]), params)
    assert [split.days(p) for p in ("initial", "validation", "stream")] == [2, 1, 0]
    assert split.fields["stream_date_min"] == "" and split.first("stream") is None
    assert period_rows(dated(spark, [0, 1, 2]), params, split, "stream").count() == 0


def test_too_few_days(spark):
    with pytest.raises(ValueError):
        split_periods(dated(spark, [0, 1, 1]), JobParams())
    empty = spark.createDataFrame([("x",)], "Date string")
    with pytest.raises(ValueError):
        split_periods(empty, JobParams())


@settings(max_examples=8, deadline=None)
@given(offsets=st.sets(st.integers(0, 400), min_size=3, max_size=60))
def test_every_day_has_one_period(spark, offsets):
    params = with_model(stream_batch_days=3)
    frame = dated(spark, sorted(offsets))
    days = calendar(frame, params).orderBy("ord").collect()
    assert [d["ord"] for d in days] == list(range(len(offsets)))
    row = boundaries(calendar(frame, params)).first()
    sizes = [row[f"{p}_date_count"] for p in ("initial", "validation", "stream")]
    assert sum(sizes) == len(offsets) and sizes[0] == max(1, len(offsets) // 2)
    stream = [d["batch_id"] for d in days if d["period"] == "stream"]
    assert stream == [i // 3 for i in range(len(stream))]


def test_known_and_rolling_rows(spark):
    frame = dated(spark, range(10))
    until = date(2024, 1, 8)
    assert known_rows(frame, JobParams(), until).count() == 8
    params = with_model(rolling_train_period_days=3)
    row = window_metadata(rolling_rows(frame, params, until), params).first()
    assert (row["rows"], row["date_min"], row["date_max"]) == (3, "2024-01-06", "2024-01-08")
    none = window_metadata(frame.where("false"), params).first()
    assert (none["rows"], none["date_min"]) == (0, "")


def test_rows_for_days(spark):
    frame = dated(spark, range(10))
    days = spark.createDataFrame([(date(2024, 1, 3),), (date(2024, 1, 9),)], "day date")
    assert rows_for_days(frame, JobParams(), days).count() == 2


def test_dates_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    dated(spark, range(10)).write.parquet(path)
    frame = spark.read.parquet(path)
    split = split_periods(frame, JobParams())
    plan = period_rows(frame, JobParams(), split, "validation")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(Date), GreaterThanOrEqual(Date" in plan
