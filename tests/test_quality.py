import pytest

from tillcast.operators.quality import (
    batch_metadata,
    cardinality,
    column_profile,
    constant_columns,
    duplicate_rows,
    iqr_outliers,
    missing_part,
    quality_report,
    schema_drift,
    source_profile,
)
from tillcast.params import ColumnRoles, JobParams, TargetParams

PARAMS = JobParams(
    roles=ColumnRoles(numeric=("n", "flat", "none"), categorical=("c",), datetime=("Date",))
)


@pytest.fixture
def frame(spark):
    rows = [("2024-01-01", float(i), 1.0, None, "a" if i % 2 else None, 10.0) for i in range(9)]
    rows.append(("2024-01-03", 1000.0, 2.0, None, "b", 10.0))
    rows.append(rows[0])
    return spark.createDataFrame(
        rows, "Date string, n double, flat double, none double, c string, Sales double"
    )


def test_missing(frame):
    row = missing_part(frame).first()
    assert (row["rows"], row["missing_cells"]) == (11, 11 + 6)
    assert row["missing_part"] == pytest.approx(17 / 66)
    assert missing_part(frame.where("false")).first()["missing_part"] == 0.0


def test_duplicates_count_after_the_first(frame):
    row = duplicate_rows(frame).first()
    assert (row["rows"], row["duplicate_rows"]) == (11, 1)
    assert duplicate_rows(frame.union(frame)).first()["duplicate_rows"] == 12
    assert duplicate_rows(frame.where("false")).first()["duplicate_part"] == 0.0


def test_constant_columns(spark, frame):
    assert {r["column"] for r in constant_columns(frame).collect()} == {"none", "Sales"}
    half = spark.createDataFrame([("x",), (None,)], "h string")
    assert constant_columns(half).count() == 0
    assert constant_columns(frame.where("false")).count() == len(frame.columns)


def test_outliers(frame):
    found = {r["column"]: r for r in iqr_outliers(frame, ["n", "flat", "none", "gone"]).collect()}
    assert found["n"]["outliers"] == 1
    # Without spread nothing is an outlier, yet the cells count; empty columns add none.
    assert (found["flat"]["outliers"], found["flat"]["values"]) == (0, 11)
    assert (found["none"]["outlier_part"], found["none"]["values"]) == (0.0, 0)
    assert found["n"]["numeric_outlier_part"] == pytest.approx(1 / 22)


def test_cardinality_and_profile(frame):
    assert cardinality(frame, ["c", "gone"]).first()["unique_values"] == 2
    assert cardinality(frame, ["c"], approximate=True).first()["unique_values"] == 2
    rows = {r["column"]: r for r in column_profile(frame).collect()}
    assert rows["c"]["dtype"] == "string" and rows["c"]["unique_values"] == 2
    assert rows["none"]["missing_part"] == 1.0 and rows["none"]["unique_values"] == 0


def test_more_columns_than_one_pass_counts(spark):
    names = [f"c{i}" for i in range(20)]
    frame = spark.createDataFrame([tuple(range(20)), tuple(range(1, 21))], names)
    found = {r["column"]: r["unique_values"] for r in cardinality(frame, names).collect()}
    assert found == {name: 2 for name in names}


def test_drift_depends_on_the_use(spark):
    params = JobParams(
        roles=ColumnRoles(numeric=("n",), categorical=("c",), ids=("Id",), service=("s",))
    )
    frame = spark.createDataFrame([(1.0, 1, 2)], "n double, Id int, extra int")

    def found(serving):
        return {(r["column"], r["kind"]) for r in schema_drift(frame, params, serving).collect()}

    assert found(False) == {
        ("c", "missing"), ("s", "missing"), ("Sales", "missing"), ("Id", "extra"),
        ("extra", "extra"),
    }
    assert found(True) == {("c", "missing"), ("s", "missing"), ("extra", "extra")}


def test_report(frame):
    row = quality_report(frame, PARAMS).first()
    assert row["rows"] == 11 and row["columns"] == 6
    assert set(row["constant_columns"]) == {"none", "Sales"}
    assert row["category_cardinality"] == {"c": 2}
    assert row["numeric_outlier_columns"]["n"] == pytest.approx(1 / 11)
    assert row["numeric_outlier_columns"]["none"] == 0.0
    assert (row["date_min"], row["date_max"]) == ("2024-01-01", "2024-01-03")
    assert (row["duplicate_rows"], row["schema_missing_columns"]) == (1, [])
    empty = quality_report(frame.where("false"), PARAMS).first()
    assert (empty["rows"], empty["missing_part"], empty["numeric_outlier_part"]) == (0, 0.0, 0.0)


def test_metadata(frame):
    params = JobParams(
        roles=PARAMS.roles, target=TargetParams("keep", add_indicator=True)
    )
    row = batch_metadata(frame, params).first()
    assert (row["rows"], row["target_missing"], row["date_count"]) == (11, 0, 2)
    assert row["numeric_features"] == 3 and row["categorical_features"] == 1
    assert row["target_missing_indicator_column"] == "Sales_WAS_MISSING"
    profile = source_profile(frame, params).first()
    assert profile["has_target_column"] and profile["features"] == 6
    without = source_profile(frame.drop("Date"), params).first()
    assert not without["has_time_column"] and without["time_min"] is None
