import pytest

from tillcast.params import JobParams, ModelParams, TargetParams, canonical_model_name


def test_defaults():
    params = JobParams()
    assert params.target.missing_strategy == "drop"
    assert params.model.selected_model == params.model.candidate_models[0]
    assert params.model.stream_batch_days == 7
    assert params.indicator_column == "Sales_WAS_MISSING"


def test_from_mapping():
    params = JobParams.from_mapping(
        {
            "time_column": "day",
            "roles": {"numeric": ["a"], "categorical": ["b"]},
            "model": {"candidate_models": ["knn", "ridge"], "training_mode": "single"},
        }
    )
    assert params.roles.numeric == ("a",)
    assert params.model.to_train() == ["knn_regression"]


@pytest.mark.parametrize(
    "bad",
    [
        {"training_mode": "some"},
        {"update_strategy": "never"},
        {"primary_metric": "r2"},
        {"candidate_models": ()},
        {"candidate_models": ("oracle",)},
        {"candidate_models": ("knn",), "selected_model": "ridge"},
        {"stream_batch_days": 0},
        {"rolling_train_period_days": 0},
        {"initial_train_ratio": 0.9, "validation_ratio": 0.1},
        {"stream_ratio": 0.0},
    ],
)
def test_bad_model_settings(bad):
    with pytest.raises(ValueError):
        ModelParams(**bad)


def test_bad_missing_strategy():
    with pytest.raises(ValueError):
        TargetParams(missing_strategy="guess")


def test_names_and_hyperparameters():
    assert canonical_model_name("knn") == "knn_regression"
    model = ModelParams(
        candidate_models=("knn", "knn_regression", "ridge"),
        selected_model="ridge",
        parameters={"knn": {"n_neighbors": 3}},
    )
    assert model.to_train() == ["knn_regression", "ridge_regression"]
    assert model.to_evaluate() == ["knn_regression", "ridge_regression"]
    assert model.hyperparameters("knn_regression") == {"n_neighbors": 3}
    assert model.hyperparameters("ridge") == {}
