from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.ml import PipelineModel

from tillcast.models.mean import ConstantModel, MeanRegressor
from tillcast.params import DimensionParams, ModelParams
from tillcast.plans.jobs import evaluate, load_source, pretrain, score_file, score_rows


def given(spark, dates=("2024-01-01", "2024-01-02")):
    rows = [
        (str(i + 1), str(i + 1), float(i + 1), d, 1.0, float(i), float(i))
        for i, d in enumerate(dates)
    ]
    return spark.createDataFrame(
        rows,
        "Id string, Store string, DayOfWeek double, Date string, Open double, Promo double, "
        "SchoolHoliday double",
    )


def test_score_file(spark, workspace, store_params, tmp_path):
    given(spark).coalesce(1).write.option("header", True).csv(str(tmp_path / "in.csv"))
    path = str(tmp_path / "in.csv")
    stores = spark.createDataFrame([("1", "a"), ("2", "b")], "Store string, StoreType string")
    model = PipelineModel([ConstantModel(value=42.0)])
    output = score_file(spark, path, store_params, workspace, stores, model)
    scored = spark.read.parquet(output)
    assert scored.columns == [*given(spark).columns, "predict"]
    assert [r["predict"] for r in scored.collect()] == [42.0, 42.0]
    row = workspace.operations.read().first()
    assert (row["operation"], row["status"]) == ("inference", "success")
    assert (row["input_rows"], row["output_rows"]) == (2, 2)


def test_a_bad_date_fails_the_file(spark, workspace, store_params, tmp_path):
    path = str(tmp_path / "in.csv")
    given(spark, ("2024-01-01", "soon")).write.option("header", True).csv(path)
    model = PipelineModel([ConstantModel(value=42.0)])
    with pytest.raises(Exception, match="does not parse"):
        score_file(spark, path, store_params, workspace, None, model)
    with pytest.raises(FileNotFoundError):
        score_file(spark, path + "x", store_params, workspace, None, model)
    stores = spark.createDataFrame([("1", "a")], "Store string, StoreType string")
    with pytest.raises(Exception, match="no StoreType for Store 2"):
        score_rows(given(spark), model, store_params, stores, "in.csv").collect()
    rows = workspace.operations.read().collect()
    assert [r["status"] for r in rows] == ["failure", "failure"]
    assert all(r["output_rows"] is None and r["error_message"] for r in rows)


def test_negative_predictions_are_clipped(spark, store_params):
    model = PipelineModel([ConstantModel(value=-3.0)])
    made = score_rows(given(spark), model, store_params, None, "in.csv")
    assert [r["predict"] for r in made.collect()] == [0.0, 0.0]


def test_scoring_needs_a_fitting_best_model(spark, workspace, store_sales, store_params, tmp_path):
    path = str(tmp_path / "in.parquet")
    store_sales.drop("Sales", "Customers").write.parquet(path)
    with pytest.raises(FileNotFoundError):
        score_file(spark, path, store_params, workspace)
    pretrained = pretrain(store_sales, store_params, workspace)
    assert pretrained.best == "ridge_regression"
    scored = spark.read.parquet(score_file(spark, path, store_params, workspace))
    assert scored.count() == 20 and scored.where("predict is null or predict < 0").count() == 0
    other = replace(
        store_params, model=replace(store_params.model, parameters={"ridge": {"alpha": 2.0}})
    )
    with pytest.raises(ValueError, match="hyperparameters differ"):
        score_file(spark, path, other, workspace)


def test_pretrain(spark, workspace, store_sales, store_params):
    pretrained = pretrain(store_sales, store_params, workspace)
    row = workspace.metrics.read().first()
    assert (row["batch_id"], row["period_type"]) == (-1, "validation")
    assert (row["train_rows"], row["valid_rows"], row["pretrain_rows"]) == (10, 4, 20)
    assert row["is_best_in_update"] and row["stream_date_count"] == 6
    assert workspace.predictions.read().count() == 4
    assert workspace.importances.read().count() > 10
    assert workspace.registry(store_params).current()["batch_id"] == -1
    # The target rises by one a day, which a ridge on the day sees.
    assert pretrained.metrics.first()["mae"] < 5
    with pytest.raises(ValueError, match="not enough rows"):
        pretrain(store_sales.where("day(Date) > 8"), store_params)


def test_evaluate(store_sales, store_params, workspace):
    model = ModelParams(candidate_models=("ridge", "knn", "decision_tree"))
    found = evaluate(store_sales, replace(store_params, model=model), workspace=workspace)
    board = found.leaderboard().collect()
    assert len(board) == 5 and board[-1]["model_name"] == "zero_baseline"
    assert board[0]["model_name"] == "ridge_regression" and board[0]["notes"]
    assert found.best_timeline().count() == 4
    assert workspace.spark.read.parquet(workspace.path("leaderboard")).count() == 5


def test_evaluate_without_models(store_sales, store_params):
    found = evaluate(store_sales, store_params, names=())
    assert found.metrics.count() == 2 and found.best_timeline() is None


def test_another_estimator_plugs_in(store_sales, store_params):
    made = pretrain(store_sales, store_params, make=lambda name: MeanRegressor())
    row = made.metrics.first()
    assert row["prediction_mean"] == pytest.approx(104.5) and row["pearson_corr"] is None


def test_load_source(spark, tmp_path, store_params):
    (tmp_path / "train.csv").write_text("Store,Date,Sales\n1,2024-01-01,5\n2,2024-01-02,6\n")
    (tmp_path / "store.csv").write_text("Store,StoreType\n1,a\n2,b\n")
    made = load_source(spark, [str(tmp_path / "train.csv")], store_params)
    assert {(r["Store"], r["StoreType"]) for r in made.collect()} == {("1", "a"), ("2", "b")}
    assert DimensionParams().key == "Store" and datetime(2024, 1, 1)
