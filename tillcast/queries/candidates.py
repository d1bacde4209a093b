"""The jobs with real models on real periods: every candidate's fit has its own derivation in SQL.

Ridge, and gradient descent to its end, solve normal equations, which SQL does by elimination. A tree
of depth one has the best of all splits, which SQL searches; a forest without resampling has that tree
in every place.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tillcast.models.factory import top_features
from tillcast.operators.features import vector_names
from tillcast.params import ColumnRoles, ModelParams
from tillcast.plans.fitting import fit_model
from tillcast.plans.jobs import Workspace, evaluate, pretrain, score_rows
from tillcast.queries.data import ORDERS, PREDICTED_SQL, customers, fact, metrics_sql, orders, rounded, split_fact
from tillcast.queries.evaluation import METRICS, RANGE_SQL
from tillcast.queries.registry import query
from tillcast.session import work_path

CHECKED = replace(
    ORDERS,
    roles=ColumnRoles(
        numeric=("c_nationkey",),
        datetime=("o_orderdate",),
        ids=("o_orderkey",),
        service=("o_custkey", "o_orderstatus", "o_orderpriority", "c_acctbal", "c_mktsegment"),
    ),
    model=ModelParams(
        candidate_models=("ridge", "sgd", "decision_tree", "random_forest"),
        training_mode="all",
        parameters={
            "ridge": {"alpha": 50.0},
            "sgd": {"alpha": 0.25, "max_iter": 3000, "tol": -1.0},  # all epochs, however small their gain
            "decision_tree": {"max_depth": 1, "min_samples_leaf": 10},
            "random_forest": {
                "n_estimators": 3, "max_depth": 1, "min_samples_leaf": 10, "bootstrap": False,
            },
        },
    ),
)

# The features in the order of the vector.
NAMES = ("c_nationkey", *(f"o_orderdate_{p}" for p in ("year", "month", "quarter", "day", "weekofyear")))
WIDTH = len(NAMES)
VALUES_SQL = """[CAST(c_nationkey AS DOUBLE), year(o_orderdate), month(o_orderdate), quarter(o_orderdate),
        day(o_orderdate), weekofyear(o_orderdate)]"""


def _weights_sql(name: str, penalty: str) -> str:
    """Normal equations with a penalty, brought to the unit matrix row by row."""
    return f"""{name}_matrix AS (
        SELECT list(v ORDER BY i) AS m FROM (
            SELECT i, list(g ORDER BY j) AS v FROM (
                SELECT i, j, g + CASE WHEN i = j THEN {penalty} ELSE 0 END AS g FROM gram)
            GROUP BY i)),
    {name}_steps AS (
        SELECT 1 AS k, m FROM {name}_matrix
        UNION ALL
        SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k
            THEN list_transform(r, lambda v: v / r[k])
            ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END)
        FROM {name}_steps WHERE k <= {WIDTH}),
    {name}_weights AS (
        SELECT t.j, m[t.j][{WIDTH + 1}] AS w
        FROM {name}_steps, range(1, {WIDTH + 1}) t(j) WHERE k = {WIDTH + 1})"""


FITS_SQL = f"""{PREDICTED_SQL},
    given AS (
        SELECT f.o_orderkey, f.o_orderdate, f.o_totalprice AS y, cal.period, {VALUES_SQL} AS x
        FROM fact f JOIN cal ON cal.day = CAST(f.o_orderdate AS DATE)),
    cells AS (
        SELECT o_orderkey, period, y, t.j, x[t.j] AS v FROM given, range(1, {WIDTH + 1}) t(j)),
    scales AS (
        SELECT j, avg(v) AS centre, CASE WHEN stddev_pop(v) = 0 THEN 1 ELSE stddev_pop(v) END AS width
        FROM cells WHERE period = 'initial' GROUP BY j),
    level AS (SELECT avg(o_totalprice) AS mean, count(*) AS n FROM initial),
    scaled AS (
        SELECT o_orderkey, period, c.y, c.j, (v - centre) / width AS z
        FROM cells c JOIN scales s ON s.j = c.j),
    known AS (SELECT * FROM scaled WHERE period = 'initial'),
    gram AS (
        SELECT a.j AS i, b.j, sum(a.z * b.z) AS g
        FROM known a JOIN known b ON b.o_orderkey = a.o_orderkey GROUP BY a.j, b.j
        UNION ALL
        SELECT j, {WIDTH + 1}, sum(z * (y - mean)) FROM known, level GROUP BY j),
    {_weights_sql("ridge", "50")},
    {_weights_sql("sgd", "(SELECT n * CAST(0.25 AS DOUBLE) FROM level)")},
    splits AS (
        SELECT j, v, below, below_sum / below AS low, (total - below_sum) / (n - below) AS high,
            below_sum * below_sum / below + (total - below_sum) * (total - below_sum) / (n - below)
                AS explained
        FROM (
            SELECT j, v, sum(count(*)) OVER upto AS below, sum(sum(y)) OVER upto AS below_sum,
                sum(count(*)) OVER every AS n, sum(sum(y)) OVER every AS total
            FROM cells WHERE period = 'initial' GROUP BY j, v
            WINDOW upto AS (PARTITION BY j ORDER BY v), every AS (PARTITION BY j))
        WHERE below >= 10 AND n - below >= 10),
    split_at AS (SELECT * FROM splits ORDER BY explained DESC LIMIT 1),
    linear AS (
        SELECT o_orderkey, sum(r.w * z) AS ridge, sum(s.w * z) AS sgd
        FROM scaled JOIN ridge_weights r ON r.j = scaled.j JOIN sgd_weights s ON s.j = scaled.j
        GROUP BY o_orderkey),
    guessed AS (
        SELECT g.o_orderkey, g.o_orderdate, g.period, g.y AS actual,
            greatest(mean + ridge, 0) AS ridge_regression, greatest(mean + sgd, 0) AS sgd_regression,
            CASE WHEN x[t.j] <= t.v THEN low ELSE high END AS decision_tree_regression,
            CASE WHEN x[t.j] <= t.v THEN low ELSE high END AS random_forest_regression,
            CAST(0 AS DOUBLE) AS zero_baseline, mean AS mean_baseline
        FROM given g JOIN linear l ON l.o_orderkey = g.o_orderkey, level, split_at t),
    checked AS (
        UNPIVOT (SELECT * FROM guessed WHERE period = 'validation')
        ON ridge_regression, sgd_regression, decision_tree_regression, random_forest_regression,
            zero_baseline, mean_baseline
        INTO NAME model_name VALUE prediction),
    scored AS (SELECT model_name, {metrics_sql()}, {RANGE_SQL} FROM checked GROUP BY model_name)"""
FITS_SQL = f"RECURSIVE {FITS_SQL}"

PROJECT_SQL = "model_name NOT IN ('zero_baseline', 'mean_baseline')"
SPLIT_FIELDS = ("train_rows", "train_window_date_min", "train_window_date_max", "date_min", "date_max")


def _rounded_sql(columns) -> str:
    return ", ".join(f"round({c} + 1e-7, 3) AS {c}" for c in columns)


@query(
    "candidates",
    f"""WITH {FITS_SQL}
    SELECT model_name, {_rounded_sql(METRICS)},
        CASE WHEN {PROJECT_SQL} THEN '' END AS notes FROM scored""",
)
def candidates(spark, folder):
    """Ridge, gradient descent, tree and forest beside the baselines, on the same periods."""
    found = evaluate(fact(spark, folder), CHECKED).leaderboard()
    return rounded(found.select("model_name", *METRICS, "notes"), 3, *METRICS)


@query(
    "candidates_timeline",
    f"""WITH {FITS_SQL},
    best AS (SELECT model_name FROM scored WHERE {PROJECT_SQL} ORDER BY rmse LIMIT 1)
    SELECT CAST(o_orderdate AS DATE) AS date, round(sum(actual) + 1e-7, 3) AS actual,
        round(sum(prediction) + 1e-7, 3) AS prediction,
        CAST(CAST(o_orderdate AS DATE) - (SELECT min(CAST(o_orderdate AS DATE)) FROM checked) AS INTEGER)
            AS day_offset
    FROM checked JOIN best ON best.model_name = checked.model_name GROUP BY CAST(o_orderdate AS DATE)""",
)
def candidates_timeline(spark, folder):
    """The day totals of the best candidate."""
    found = evaluate(fact(spark, folder), CHECKED).best_timeline()
    return rounded(found, 3, "actual", "prediction")


@query(
    "pretrain_candidates",
    f"""WITH {FITS_SQL}
    SELECT model_name, CAST(-1 AS BIGINT) AS batch_id, 'validation' AS period_type,
        {_rounded_sql(("rmse", "mae", "smape"))},
        (SELECT count(*) FROM initial) AS train_rows,
        (SELECT strftime(min(o_orderdate), '%Y-%m-%d') FROM initial) AS train_window_date_min,
        (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM initial) AS train_window_date_max,
        (SELECT strftime(min(o_orderdate), '%Y-%m-%d') FROM validation) AS date_min,
        (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM validation) AS date_max
    FROM scored WHERE {PROJECT_SQL}""",
)
def pretrain_candidates(spark, folder):
    """What pretraining writes about every candidate into a workspace."""
    workspace = Workspace(spark, work_path(spark, "candidates"))
    pretrain(fact(spark, folder), CHECKED, workspace)
    shown = ("model_name", "batch_id", "period_type", "rmse", "mae", "smape", *SPLIT_FIELDS)
    found = workspace.metrics.read().withColumn("batch_id", F.col("batch_id").cast("long"))
    return rounded(found.select(*shown), 3, "rmse", "mae", "smape")


NAMED_SQL = "[" + ", ".join(f"'{name}'" for name in NAMES) + "]"


@query(
    "candidate_weights",
    f"""WITH {FITS_SQL}
    SELECT 'ridge_regression' AS model_name, {NAMED_SQL}[j] AS feature, round(w + 1e-7, 3) AS value,
        round(abs(w) + 1e-7, 3) AS abs_value FROM ridge_weights
    UNION ALL
    SELECT 'sgd_regression', {NAMED_SQL}[j], round(w + 1e-7, 3), round(abs(w) + 1e-7, 3)
    FROM sgd_weights""",
)
def candidate_weights(spark, folder):
    """The ranked features of the linear candidates, as pretraining wrote them."""
    workspace = Workspace(spark, work_path(spark, "candidates"))
    linear = replace(CHECKED, model=replace(CHECKED.model, candidate_models=("ridge", "sgd")))
    pretrain(fact(spark, folder), linear, workspace)
    found = workspace.importances.read().select("model_name", "feature", "value", "abs_value")
    return rounded(found, 3, "value", "abs_value")


@query(
    "heaviest_weights",
    f"""WITH {FITS_SQL}
    SELECT {NAMED_SQL}[j] AS feature, round(w + 1e-7, 3) AS value, round(abs(w) + 1e-7, 3) AS abs_value
    FROM ridge_weights ORDER BY abs(w) DESC, 1 LIMIT 5""",
)
def heaviest_weights(spark, folder):
    """The five features ridge weighs most."""
    initial, _, _ = split_fact(spark, folder)
    stages = fit_model(initial, CHECKED, "ridge_regression").stages
    found = top_features(spark, stages[-1], vector_names(stages), first=5)
    return rounded(found, 3, "value", "abs_value")


@query(
    "batch_score_ridge",
    f"""WITH {FITS_SQL}
    SELECT o.*, round(g.ridge_regression + 1e-7, 3) AS predict
    FROM orders o JOIN guessed g ON g.o_orderkey = o.o_orderkey""",
)
def batch_score_ridge(spark, folder):
    """All orders, those of the stream too, scored by ridge trained on the initial period."""
    initial, _, _ = split_fact(spark, folder)
    model = fit_model(initial, CHECKED, "ridge_regression")
    scored = score_rows(orders(spark, folder), model, CHECKED, customers(spark, folder))
    return rounded(scored, 3, "predict")
