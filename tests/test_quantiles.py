import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillcast.operators.quality import iqr_outliers
from tillcast.operators.quantiles import exact_quantiles
from tillcast.operators.ranking import dense_index, row_order

SHARES = (0.01, 0.25, 0.5, 0.75, 0.99)


def frame_of(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


def check(spark, values, direct_rows, accuracy=20):
    frame = frame_of(spark, values)
    count, found = exact_quantiles(frame, {"x": F.col("x")}, SHARES, direct_rows, accuracy)["x"]
    present = np.array([v for v in values if v is not None], dtype=float)
    assert count == len(present)
    np.testing.assert_allclose(found, np.quantile(present, SHARES), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("direct_rows", [5, 100, 10_000])
def test_against_numpy(spark, direct_rows):
    values = np.random.default_rng(3).lognormal(0, 3, 4000)
    check(spark, [*values, None, None], direct_rows)


def test_hot_values(spark):
    """A third of the rows are one value and another third a second one."""
    rng = np.random.default_rng(4)
    check(spark, [*rng.normal(size=700), *[0.0] * 700, *[1.5] * 700], direct_rows=5)
    check(spark, [0.0] * 500 + [1.0] * 500, direct_rows=5)


def test_the_source_is_read_once(spark):
    """However many rounds the search takes, and with the outliers counted at the end."""
    values = np.random.default_rng(5).lognormal(0, 3, 3000)
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    frame = frame_of(spark, values).mapInArrow(counting, "x double")
    _, found = exact_quantiles(frame, {"x": F.col("x")}, SHARES, 5, 20)["x"]
    np.testing.assert_allclose(found, np.quantile(values, SHARES), rtol=1e-12)
    assert read.value == len(values)
    low, high = np.quantile(values, (0.25, 0.75))
    outside = (values < low - 1.5 * (high - low)) | (values > high + 1.5 * (high - low))
    row = iqr_outliers(frame, ["x"], direct_rows=5).first()
    assert (row["values"], row["outliers"]) == (3000, outside.sum()) and read.value == 2 * len(values)


def test_nothing_to_count(spark):
    assert exact_quantiles(frame_of(spark, [None]), {"x": F.col("x")}, (0.5,)) == {"x": (0, None)}
    assert exact_quantiles(frame_of(spark, [1]), {}, (0.5,)) == {}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=200))
def test_any_values(spark, values):
    check(spark, values, direct_rows=3, accuracy=10)


@pytest.mark.parametrize("one_task_rows", [0, 10_000])
def test_positions(spark, one_task_rows):
    rows = [(i % 3, i) for i in range(999)]
    frame = spark.createDataFrame(rows, "a long, b long").repartition(7)
    made = dense_index(frame, ["a", "b"], "at", 999, one_task_rows).collect()
    assert [(r["a"], r["b"]) for r in sorted(made, key=lambda r: r["at"])] == sorted(rows)
    assert sorted(r["at"] for r in made) == list(range(999))


def test_row_order(spark):
    frame = spark.sql(
        "select * from values (timestamp_ntz'1969-12-31 23:59:59.5', 5L, 0), "
        "(timestamp_ntz'2024-01-01 00:00:00', 9L, 2), (timestamp_ntz'2024-01-01 00:00:00', 1L, 1), "
        "(timestamp_ntz'2024-01-01 00:00:00.000001', 0L, 3) as t(at, k, place)"
    )
    made = frame.orderBy(row_order(F.col("at"), F.col("k"))).collect()
    assert [r["place"] for r in made] == [0, 1, 2, 3]


def test_columns_of_few_values_need_no_sketch(spark, monkeypatch):
    """They are counted by value, however many rows there are; other columns' ranks share one sketch."""
    sketched, sketch = [], F.percentile_approx

    def noted(*arguments):
        sketched.append(arguments)
        return sketch(*arguments)

    monkeypatch.setattr(F, "percentile_approx", noted)
    few = [float(i % 7) for i in range(500)]
    frame = spark.createDataFrame([(v, float(i)) for i, v in enumerate(few)], "few double, many double")
    found = exact_quantiles(frame, {"few": F.col("few")}, SHARES, 100, 20)["few"]
    np.testing.assert_allclose(found[1], np.quantile(few, SHARES))
    assert not sketched
    found = exact_quantiles(frame, {"many": F.col("many")}, (0.5,), 400, 20)["many"]
    assert found == (500, [249.5]) and len(sketched) == 1
