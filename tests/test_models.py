import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors

from tillcast.models.factory import importances, make_estimator, signature, top_features
from tillcast.models.knn import (
    KnnModel,
    KnnRegressor,
    cell_of,
    cells_within,
    region_by_region,
    split_space,
)
from tillcast.models.linear import (
    UPDATE_EPOCHS,
    GradientModel,
    GradientRegressor,
    RidgeRegressor,
    moments,
)
from tillcast.models.mean import MeanRegressor
from tillcast.models.protocol import supports_incremental_update
from tillcast.models.registry import champions
from tillcast.params import ModelParams
from tillcast.session import work_path


def rows_of(spark, x, y):
    made = [(i, Vectors.dense(a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(made, ["id", "features", "label"])


def predicted(model, frame):
    found = model.transform(frame).select("id", "prediction").collect()
    return np.array([r["prediction"] for r in sorted(found)])


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    y = x @ [3.0, -2.0, 0.5] + 7 + rng.normal(scale=0.1, size=300)
    return x, y, rows_of(spark, x, y).persist()


def test_ridge_is_the_closed_form(linear):
    x, y, frame = linear
    model = RidgeRegressor(alpha=20.0).fit(frame)
    centred = x - x.mean(axis=0)
    expected = np.linalg.solve(centred.T @ centred + 20 * np.eye(3), centred.T @ (y - y.mean()))
    np.testing.assert_allclose(model.coefficients.toArray(), expected, rtol=1e-6)
    assert model.intercept == pytest.approx(y.mean() - x.mean(axis=0) @ expected)


def test_gradient_descent(spark, linear):
    x, y, frame = linear
    rows, gram, cross, square = moments(frame)
    whole = np.column_stack([np.ones(300), x])
    assert rows == 300 and square == pytest.approx(y @ y)
    np.testing.assert_allclose(gram, whole.T @ whole, rtol=1e-9)
    model = GradientRegressor(tol=1e-6).fit(frame)
    assert np.mean((predicted(model, frame) - y) ** 2) < 0.01 * y.var()
    assert supports_incremental_update(model) and not supports_incremental_update(MeanRegressor())
    updated = model.updated(frame)
    assert updated.getOrDefault("steps") == model.getOrDefault("steps") + UPDATE_EPOCHS
    before, after = (np.mean((predicted(m, frame) - y) ** 2) for m in (model, updated))
    assert after <= before * (1 + 1e-6)
    path = work_path(spark, "sgd")
    updated.write().save(path)
    np.testing.assert_allclose(predicted(GradientModel.load(path), frame), predicted(updated, frame))


def test_gradient_descent_on_raw_scales(spark):
    """Unscaled codes would throw a fixed step off."""
    x = np.column_stack([np.arange(2000.0), np.tile([0.0, 1.0], 1000)])
    y = 2 * x[:, 0] + 5 * x[:, 1] + 100
    frame = rows_of(spark, x, y)
    model = GradientRegressor(maxIter=300, tol=1e-9).fit(frame)
    np.testing.assert_allclose(predicted(model, frame), y, rtol=0.05)


def test_gradient_descent_ends_at_ridge(spark, linear):
    x, y, frame = linear
    model = GradientRegressor(alpha=0.2, tol=1e-14).fit(frame)
    ridge = RidgeRegressor(alpha=0.2 * len(y)).fit(frame)
    np.testing.assert_allclose(predicted(model, frame), predicted(ridge, frame), rtol=1e-5)


def test_a_shifted_batch_moves_the_model_most_of_the_way(spark):
    x = np.linspace(-1, 1, 200)[:, None]
    model = GradientRegressor(tol=1e-9).fit(rows_of(spark, x, np.full(200, 100.0)))
    assert predicted(model, rows_of(spark, x, x[:, 0])) == pytest.approx(100.0, abs=0.1)
    moved = model.updated(rows_of(spark, x, np.full(200, 200.0)))
    assert predicted(moved, rows_of(spark, x, x[:, 0])) == pytest.approx(200.0, abs=5)


def test_hyperparameters_are_taken_or_refused():
    assert make_estimator("decision_tree", {}, 1).getMaxDepth() == 30
    assert make_estimator("decision_tree", {"max_depth": 4, "max_bins": 64}, 1).getMaxBins() == 64
    with pytest.raises(ValueError, match="max_depth"):
        make_estimator("random_forest", {"max_depth": 50}, 1)
    for name, wrong in (("ridge", {"penalty": "l1"}), ("sgd", {"loss": "huber"})):
        with pytest.raises(ValueError, match="unknown hyperparameters"):
            make_estimator(name, wrong, 1)


def brute_force(x, y, asked, k, weights="distance"):
    out = []
    for q in asked:
        d = np.sqrt(((x - q) ** 2).sum(axis=1))
        near = np.lexsort((y, d))[:k]
        if weights == "uniform":
            out.append(y[near].mean())
        elif (d[near] == 0).any():
            out.append(y[near][d[near] == 0].mean())
        else:
            out.append(np.average(y[near], weights=1 / d[near]))
    return np.array(out)


@pytest.mark.parametrize("weights", ["distance", "uniform"])
@pytest.mark.parametrize("sizes", [(10_000, 10_000, 10_000), (40, 15, 10), (30, 15, 10, 3)])
def test_knn_against_brute_force(spark, weights, sizes):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 3))
    # A third of the rows are one and the same point.
    x[:133] = 0.25
    y = rng.uniform(size=400)
    asked = np.vstack([rng.normal(size=(60, 3)), x[[0, 200]], rng.normal(size=(5, 3)) * 50])
    cell, block, query, *regions = sizes
    more = {"regions": regions[0]} if regions else {}
    model = KnnRegressor(
        k=8, weights=weights, cellRows=cell, blockRows=block, queryRows=query, **more
    )
    fitted = model.fit(rows_of(spark, x, y))
    found = predicted(fitted, rows_of(spark, asked, np.zeros(len(asked))))
    np.testing.assert_allclose(found, brute_force(x, y, asked, 8, weights), rtol=1e-9)


@pytest.mark.parametrize("regions", [2, 4096])
def test_knn_with_fewer_rows_than_neighbours(spark, regions):
    x, y = np.array([[0.0], [1.0], [5.0]]), np.array([1.0, 2.0, 3.0])
    model = KnnRegressor(k=8, cellRows=1, regions=regions).fit(rows_of(spark, x, y))
    asked = np.array([[0.0], [2.0]])
    found = predicted(model, rows_of(spark, asked, [0, 0]))
    np.testing.assert_allclose(found, brute_force(x, y, asked, 3))
    path = work_path(spark, "knn")
    model.write().save(path)
    np.testing.assert_allclose(predicted(KnnModel.load(path), rows_of(spark, asked, [0, 0])), found)


def test_cells_grow_with_the_rows(spark):
    """Past the regions, every region has a tree of its own; no cell keeps far more than its share."""
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(1200, 2)), rng.uniform(size=1200)
    for rows in (300, 1200):
        model = KnnRegressor(k=3, cellRows=20, regions=4).fit(rows_of(spark, x[:rows], y[:rows]))
        sizes = [r["rows"] for r in model.bounds.collect()]
        assert len(sizes) == model.getOrDefault(model.cells) >= rows / 25 and max(sizes) <= 40
        assert sum(sizes) == rows and model.trees.count() == 4


def test_trees_of_regions_are_copied_by_rows_met(spark, monkeypatch):
    """Small blocks don't mean a copy of the tree for each, nor a task, nor pairs of queries and cells."""
    rng = np.random.default_rng(9)
    x, y = rng.normal(size=(600, 2)), rng.uniform(size=600)
    model = KnnRegressor(k=3, cellRows=10, blockRows=4, queryRows=4, regions=2).fit(rows_of(spark, x, y))
    points = spark.createDataFrame(
        [(i, 0, x[i].tolist()) for i in range(100)], "query long, region int, x array<double>"
    )
    met = region_by_region(
        points, model.trees, "query", 4,
        lambda some, tree: pd.DataFrame({"points": [len(some)], "trees": [len(tree)]}),
        "points long, trees long",
    )
    assert sorted(map(tuple, met.collect())) == [(100, 1)]
    monkeypatch.setattr("tillcast.models.knn.MEETING_ROWS", 30)
    asked = rng.normal(size=(100, 2))
    found = predicted(model, rows_of(spark, asked, np.zeros(100)))
    np.testing.assert_allclose(found, brute_force(x, y, asked, 3), rtol=1e-9)


def test_reached_cells_are_those_whose_boxes_are_near():
    rng = np.random.default_rng(10)
    rows, asked = rng.normal(size=(2000, 3)), rng.normal(size=(50, 3))
    tree = {k: np.asarray(v) for k, v in split_space(rows, 64).items()}
    cells = cell_of(rows, tree)
    low = np.array([rows[cells == c].min(axis=0) for c in range(64)])
    high = np.array([rows[cells == c].max(axis=0) for c in range(64)])
    reach = np.append(rng.uniform(size=49), np.inf)
    found = set(zip(*map(list, cells_within(asked, reach, tree, low, high))))
    gaps = np.maximum(np.maximum(low - asked[:, None], asked[:, None] - high), 0)
    every = np.argwhere(np.sqrt((gaps**2).sum(axis=2)) <= reach[:, None])
    assert found == set(map(tuple, every)) and len(every) < 49 * 40 + 64


def test_cells_cover_space():
    rng = np.random.default_rng(7)
    points = rng.normal(size=(1000, 2))
    tree = {k: np.asarray(v) for k, v in split_space(points, 16).items()}
    cells = cell_of(points, tree)
    assert set(cells) == set(range(16)) and np.bincount(cells).max() < 100
    same = split_space(np.ones((50, 2)), 16)
    assert same["cell"] == [0]


@pytest.mark.parametrize(
    "name, given", [("decision_tree", {}), ("random_forest", {"n_estimators": 5})]
)
def test_trees_beat_the_mean(linear, name, given):
    x, y, frame = linear
    estimator = make_estimator(name, {"min_samples_leaf": 10, **given}, seed=1)
    model = estimator.fit(frame)
    assert np.mean((predicted(model, frame) - y) ** 2) < 0.3 * y.var()
    np.testing.assert_array_equal(predicted(model, frame), predicted(estimator.fit(frame), frame))
    assert importances(model, ["a", "b", "c"])[0][0] == "a"


def test_a_forest_in_less_memory_is_the_same(linear):
    _, _, frame = linear
    estimator = make_estimator("random_forest", {"n_estimators": 4, "min_samples_leaf": 2}, seed=1)
    # Four tasks of an executor hold that much each.
    assert estimator.getMaxMemoryInMB() <= 256
    found = [
        predicted(estimator.copy({estimator.maxMemoryInMB: mb}).fit(frame), frame) for mb in (1, 1024)
    ]
    np.testing.assert_allclose(found[0], found[1], rtol=1e-12)
    np.testing.assert_allclose(predicted(estimator.fit(frame), frame), found[1], rtol=1e-12)


def test_factory(spark, linear):
    _, _, frame = linear
    with pytest.raises(ValueError):
        make_estimator("oracle", {}, 1)
    tree = make_estimator("decision_tree", {"min_samples_leaf": 7}, seed=3)
    assert tree.getMaxDepth() == 30 and tree.getMinInstancesPerNode() == 7 and tree.getSeed() == 3
    params = ModelParams(parameters={"knn": {"n_neighbors": 3}})
    assert signature(params, "knn") == signature(params, "knn_regression")
    assert signature(params, "knn") != signature(ModelParams(), "knn")
    ridge = RidgeRegressor(alpha=1.0).fit(frame)
    assert importances(ridge, ["too", "few"]) is None
    assert importances(MeanRegressor().fit(frame), ["a", "b", "c"]) is None
    ranked = [r["feature"] for r in top_features(spark, ridge, ["a", "b", "c"]).collect()]
    assert ranked == ["a", "b", "c"]


def test_champions(spark):
    rows = [
        (-1, "s", 5.0),
        (0, "s", 5.0),  # a tie keeps the earlier one
        (1, "s", 4.0),
        (2, "s", 6.0),
        (3, "t", 9.0),  # another signature always takes over
        (4, "t", 8.0),
        (5, "s", 7.0),
        (6, "s", None),
    ]
    frame = spark.createDataFrame(
        [(b, "1", s, v) for b, s, v in rows],
        "batch_id long, preprocessing_version string, signature string, rmse double",
    )
    made = champions(frame, "rmse").orderBy("batch_id").collect()
    assert [r["best_batch_id"] for r in made] == [-1, -1, 1, 1, 3, 4, 5, 5]


def test_a_version_without_score_gives_way(spark):
    frame = spark.createDataFrame(
        [(0, "1", "s", None), (1, "1", "s", None), (2, "1", "s", 3.0)],
        "batch_id long, preprocessing_version string, signature string, rmse double",
    )
    made = champions(frame, "rmse").orderBy("batch_id").collect()
    assert [r["best_batch_id"] for r in made] == [0, 1, 2]
