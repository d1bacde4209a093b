import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tillcast.operators.clean import clean_training
from tillcast.operators.features import (
    MISSING,
    FeaturePreprocessor,
    FrequencyEncoder,
    FrequencyModel,
    MedianScaler,
    build_features,
    category_table,
    feature_names,
    labelled,
    numeric_statistics,
    vector_names,
    with_features,
)
from tillcast.plans.fitting import training_rows
from tillcast.session import work_path


def test_projection_leaves_out_what_must_not_be_known(store_sales, store_params):
    frame = store_sales.withColumn("Id", F.lit("10"))
    columns = build_features(frame, store_params).columns
    assert not {"Id", "Customers", "_source_file", "Sales", "Date"} & set(columns)
    assert {f"Date_{p}" for p in ("year", "month", "quarter", "day", "weekofyear")} < set(columns)
    numeric, categorical = feature_names(frame.columns, store_params)
    assert "Store" in categorical and "DayOfWeek" in numeric


def test_rows_keep_their_columns(store_sales, store_params):
    made = with_features(store_sales, store_params)
    assert made.columns[: len(store_sales.columns)] == store_sales.columns
    assert dict(made.dtypes)["x__Store"] == "string"


def test_labels(spark, store_params):
    frame = spark.createDataFrame([("3",), ("x",), (None,)], "Sales string")
    assert [r["label"] for r in labelled(frame, store_params).collect()] == [3.0]
    with pytest.raises(ValueError):
        labelled(frame.drop("Sales"), store_params)


def test_median_and_scale(spark):
    rows = [(1.0, 5.0, None), (2.0, 5.0, None), (None, 5.0, None), (10.0, 5.0, None)]
    frame = spark.createDataFrame(rows, "a double, flat double, none double")
    found = numeric_statistics(frame, ["a", "flat", "none"])
    assert "none" not in found and found["flat"].deviation == 1.0
    filled = np.array([1.0, 2.0, 2.0, 10.0])
    assert found["a"].median == 2.0
    assert found["a"].mean == pytest.approx(filled.mean())
    assert found["a"].deviation == pytest.approx(filled.std())
    model = MedianScaler(columns=["a", "flat", "none"]).fit(frame)
    made = [r["a"] for r in model.transform(frame).collect()]
    np.testing.assert_allclose(made, (filled - filled.mean()) / filled.std())
    assert [r["flat"] for r in model.transform(frame).collect()] == [0.0] * 4


def ordered(spark):
    rows = [(3, "b"), (1, "c"), (2, None), (5, "b"), (4, "a"), (6, "b")]
    return spark.createDataFrame(rows, "at long, c string")


@pytest.mark.parametrize("one_task_rows", [0, 1000])
def test_codes_follow_first_appearance(spark, one_task_rows):
    at = F.col("at").cast("decimal(38,0)")
    table = category_table(ordered(spark), ["c"], at, one_task_rows).collect()
    found = {r["value"]: (r["code"], r["frequency"]) for r in table}
    assert found == {
        "c": (0.0, 1 / 6), "__MISSING__": (1.0, 1 / 6), "b": (2.0, 0.5), "a": (3.0, 1 / 6),
    }


def test_unseen_categories_and_storage(spark):
    frame = ordered(spark).withColumn("_row_order", F.col("at").cast("decimal(38,0)"))
    model = FrequencyEncoder(columns=["c"]).fit(frame)
    path = work_path(spark, "encoder")
    model.save(path)
    asked = spark.createDataFrame([("b",), ("zzz",), (None,)], "c string")
    for used in (model, FrequencyModel.load(path), model.copy()):
        made = [(r["c"], r["c_frequency"]) for r in used.transform(asked).collect()]
        assert sorted(made) == [(-1.0, 0.0), (1.0, 1 / 6), (2.0, 0.5)]
    assert model.output_names() == ["c", "c_frequency"]


@pytest.mark.parametrize("room", [0, 250, 10**6])
def test_one_join_gives_the_codes_of_many_columns(spark, room):
    """Hot, unseen, missing and repeated values; rows that repeat as a whole; a map among the columns."""
    rows = [(i, "hot" if i % 3 else f"v{i % 40}", None if i % 5 == 0 else f"w{i % 7}", i % 4) for i in range(400)]
    frame = spark.createDataFrame(rows, "_row_order long, c string, d string, e long")
    asked = [(f"x{i % 3}", "hot" if i % 2 else f"v{i % 50}", f"w{i % 9}" if i % 4 else None, i % 6) for i in range(300)]
    asked = spark.createDataFrame(asked + asked[:50], "k string, c string, d string, e long")
    asked = asked.withColumn("m", F.create_map("k", "e")).withColumn("d_old", F.lit(None).cast("int"))
    encoder = FrequencyEncoder(columns=["c", "d", "e"], broadcastBytes=room)
    model = encoder.fit(frame.withColumn("_row_order", F.col("_row_order").cast("decimal(38,0)")))
    context = spark.sparkContext
    context.setJobGroup(f"transform-{room}", "no job may run")
    made = model.transform(asked)
    assert not context.statusTracker().getJobIdsForGroup(f"transform-{room}")
    context.setJobGroup("tests", "")
    assert made.columns == ["k", "c", "d", "e", "m", "d_old", "c_frequency", "d_frequency", "e_frequency"]
    codes = {(r["column"], r["value"]): (r["code"], r["frequency"]) for r in model.table.collect()}
    expected = []
    for r in asked.collect():
        found = [codes.get((c, MISSING if r[c] is None else str(r[c])), (-1.0, 0.0)) for c in "cde"]
        expected.append(str((r["k"], r["m"], *[f[0] for f in found], *[f[1] for f in found])))
    found = [str((r["k"], r["m"], *r[1:4], *r[6:9])) for r in made.collect()]
    assert sorted(found) == sorted(expected)


def test_preprocessor(spark, store_sales, store_params):
    cleaned = clean_training(store_sales, store_params)
    rows = training_rows(cleaned, store_params)
    fitted = FeaturePreprocessor.for_table(cleaned.columns, store_params).fit(rows)
    names = vector_names(fitted.stages)
    assert names.index("Date_weekofyear") < names.index("Store")
    assert names[-2:] == ["PromoInterval", "PromoInterval_frequency"]
    path = work_path(spark, "preprocessor")
    fitted.write().save(path)
    vectors = vector_to_array("features").alias("v")
    first = fitted.transform(rows).select("Date", vectors).orderBy("Date").collect()
    again = PipelineModel.load(path).transform(rows).select("Date", vectors).orderBy("Date")
    assert first == again.collect()
    stores = [r["v"][names.index("Store")] for r in first]
    assert stores == [0.0, 1.0] * 10
