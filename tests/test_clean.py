import pytest
from pyspark.sql import functions as F

from tillcast.functions.columns import (
    calendar_parts,
    clipped,
    close,
    finite,
    not_below_zero,
    number,
    share,
    sorted_json,
)
from tillcast.operators.clean import clean_serving, clean_training, drop_leakage, treat_target
from tillcast.params import (
    SOURCE_FILE,
    ColumnRoles,
    DimensionParams,
    FileParams,
    JobParams,
    TargetParams,
)
from tillcast.sources.files import (
    locate_dimension,
    read_file,
    read_sources,
    union_sources,
    with_times,
)


def values(frame, name):
    return [r[name] for r in frame.collect()]


def test_number_from_text(spark):
    frame = spark.createDataFrame(
        [(t,) for t in ["1", " 2.5 ", "x", "", None, "NaN", "inf", "1d", "2f", "1e3"]], "t string"
    )
    made = values(frame.select(number(frame, "t").alias("n")), "n")
    assert made == [1.0, 2.5, None, None, None, None, float("inf"), None, None, 1000.0]


def test_small_expressions(spark):
    frame = spark.createDataFrame([(-1.0, 0), (2.0, 4), (None, 2)], "x double, n int")
    assert values(frame.select(not_below_zero(F.col("x")).alias("v")), "v") == [0.0, 2.0, None]
    made = values(frame.select(share(F.lit(1), F.col("n")).alias("v")), "v")
    assert made == [0.0, 0.25, 0.5]
    held = clipped(F.col("x"), F.lit(0.0), F.lit(1.0))
    assert values(frame.select(held.alias("v")), "v") == [0.0, 1.0, None]
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,), (None,)], "x double")
    assert values(odd.select(finite(F.col("x")).alias("v")), "v")[2] is True
    assert odd.where(finite(F.col("x"))).count() == 1
    near = spark.range(1).select(close(F.lit(1.0), F.lit(1.000001)).alias("v"))
    assert values(near, "v") == [True]
    text = spark.range(1).select(
        sorted_json(F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2))).alias("v")
    )
    assert values(text, "v") == ['{"a":2,"b":1}']


def test_iso_week_at_the_turn_of_a_year(spark):
    frame = spark.sql("select timestamp_ntz'2021-01-03' as t")
    row = frame.select(*calendar_parts(F.col("t"), "t")).first()
    assert (row["t_year"], row["t_weekofyear"]) == (2021.0, 53.0)


@pytest.mark.parametrize(
    "strategy, expected",
    [
        ("drop", [1.0]),
        ("keep", [1.0, None, None]),
        ("fill_zero", [1.0, 0.0, 0.0]),
        ("fill_value", [1.0, 7.0, 7.0]),
    ],
)
def test_missing_targets(spark, strategy, expected):
    frame = spark.createDataFrame([("1",), ("x",), (None,)], "Sales string")
    params = JobParams(target=TargetParams(strategy, 7.0, add_indicator=True))
    made = treat_target(frame, params)
    assert values(made, "Sales") == expected
    assert values(made, "Sales_WAS_MISSING") == [int(i > 0) for i in range(len(expected))]


def test_cleaning(spark):
    roles = ColumnRoles(
        numeric=("n",), categorical=("c",), datetime=("Date", "d"), ids=("Id",),
        service=("Customers", SOURCE_FILE),
    )
    frame = spark.createDataFrame(
        [
            ("2024-01-02", "5", 1, "2024-01-01", 9, 3, "f", "2"),
            ("no date", "6", 2, "2024-01-01", 9, 3, "f", "2"),
            ("2024-01-01", None, 3, "bad", 9, 3, "f", "x"),
        ],
        f"Date string, Sales string, c int, d string, Id int, Customers int, {SOURCE_FILE} string, "
        "n string",
    )
    params = JobParams(roles=roles)
    kinds = dict(clean_training(frame, params).dtypes)
    assert "Customers" not in kinds and SOURCE_FILE in kinds
    assert kinds["c"] == "string" and kinds["Id"] == "string" and kinds["n"] == "double"
    assert clean_training(frame, params).count() == 1
    serving = clean_serving(frame, params)
    assert serving.count() == 2
    assert sorted(values(serving, "n"), key=str) == [2.0, None]
    assert sum(v is None for v in values(serving, "d")) == 1
    with pytest.raises(ValueError):
        clean_training(frame.drop("Date"), params)
    with pytest.raises(ValueError):
        clean_training(frame.drop("Sales"), params)
    assert drop_leakage(frame, params).columns == [c for c in frame.columns if c != "Customers"]


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Store,Date,Sales\n1,2024-01-01,5\n")
    (tmp_path / "b.csv").write_text("Store,Date\n2,2024-01-02\n3,2024-01-03\n")
    (tmp_path / "store.csv").write_text("Store,StoreType\n1,a\n")
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    made = read_sources(spark, paths)
    assert sorted(values(made, SOURCE_FILE)) == ["a.csv", "b.csv", "b.csv"]
    assert sorted(values(made, "Sales"), key=str) == ["5", None, None]
    with pytest.raises(FileNotFoundError):
        read_file(spark, str(tmp_path / "c.csv"))
    with pytest.raises(ValueError):
        union_sources([])
    assert locate_dimension(spark, DimensionParams(), paths).endswith("store.csv")
    given = DimensionParams(path="elsewhere.csv")
    assert locate_dimension(spark, given, paths) == "elsewhere.csv"
    assert locate_dimension(spark, DimensionParams(file_name="none.csv"), paths) is None


def test_csv_as_other_tools_write_it(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Store,Name,n\n1,"a ""b"" c",5\n2,"two\nlines",6\n3,NA,NaN\n')
    rows = read_file(spark, str(tmp_path / "a.csv")).collect()
    assert [(r["Store"], r["Name"], r["n"]) for r in rows] == [
        ("1", 'a "b" c', "5"), ("2", "two\nlines", "6"), ("3", None, None),
    ]
    single = read_file(spark, str(tmp_path / "a.csv"), files=FileParams(False, ("5",))).collect()
    assert len(single) == 4 and single[0]["n"] is None and single[3]["Name"] == "NA"


def test_time_formats_are_tried_in_order(spark):
    texts = ["2015-07-31", "31.07.2015", "7/31/2015", "2015/07/31", "soon"]
    frame = spark.createDataFrame([(t, 1.0) for t in texts], "Date string, Sales double")
    formats = ("dd.MM.yyyy", "M/d/yyyy", "yyyy/MM/dd")
    params = JobParams(files=FileParams(time_formats=formats))
    assert {str(v)[:10] for v in values(clean_training(frame, params), "Date")} == {"2015-07-31"}
    assert clean_training(frame, params).count() == 4
    assert clean_training(frame, JobParams()).count() == 1
    made = with_times(frame, ["Date"], formats)
    assert dict(made.dtypes)["Date"] == "timestamp_ntz"
