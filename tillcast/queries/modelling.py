"""Encoders, estimators, training, evaluation and scoring."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tillcast.models.factory import estimator_for, make_estimator, top_features
from tillcast.models.knn import KnnRegressor
from tillcast.models.linear import GradientRegressor, RidgeRegressor
from tillcast.models.mean import ConstantModel, MeanRegressor
from tillcast.operators.features import (
    FeaturePreprocessor,
    FrequencyEncoder,
    MedianScaler,
    numeric_statistics,
    vector_names,
)
from tillcast.operators.metrics import regression_metrics
from tillcast.operators.ranking import row_order
from tillcast.plans.fitting import fit_model, fit_preprocessor, predict, training_rows
from tillcast.params import ColumnRoles
from tillcast.plans.jobs import Workspace, evaluate, load_source, pretrain, score_file, score_rows
from tillcast.queries.data import (
    ORDERS,
    PREDICTED_SQL,
    customers,
    fact,
    lines,
    orders,
    rounded,
    split_fact,
)
from tillcast.queries.registry import query
from tillcast.session import settled, work_path

SIZED = ("l_discount", "l_tax", "p_size", "p_retailprice")
SIZED_SQL = """sized_lines AS (
    SELECT l.l_orderkey, l.l_linenumber, nullif(l.l_discount, 0) AS l_discount, l.l_tax,
        CAST(p.p_size AS DOUBLE) AS p_size, p.p_retailprice
    FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey)"""


def _sized_lines(spark, folder):
    """Order lines on which no discount counts as missing."""
    return lines(spark, folder).select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        "l_tax",
        F.col("p_size").cast("double").alias("p_size"),
        "p_retailprice",
    )


@query(
    "median_impute",
    f"""WITH {SIZED_SQL}
    SELECT l_orderkey, l_linenumber, coalesce(l_discount, (SELECT median(l_discount)
        FROM sized_lines)) AS l_discount FROM sized_lines""",
)
def median_impute(spark, folder):
    found = _sized_lines(spark, folder)
    median = numeric_statistics(found, ["l_discount"])["l_discount"].median
    filled = F.coalesce("l_discount", F.lit(median)).alias("l_discount")
    return found.select("l_orderkey", "l_linenumber", filled)


def _scaled_sql() -> str:
    filled = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM sized_lines)) AS {c}" for c in SIZED)
    scaled = ", ".join(
        f"""round(({c} - (SELECT avg({c}) FROM filled)) / (SELECT CASE WHEN stddev_pop({c}) = 0
            THEN 1 ELSE stddev_pop({c}) END FROM filled) + 1e-7, 6) AS {c}"""
        for c in SIZED
    )
    return f"""WITH {SIZED_SQL}, filled AS (
        SELECT l_orderkey, l_linenumber, {filled} FROM sized_lines)
    SELECT l_orderkey, l_linenumber, {scaled} FROM filled"""


@query("standard_scale", _scaled_sql())
def standard_scale(spark, folder):
    found = _sized_lines(spark, folder)
    scaled = MedianScaler(columns=list(SIZED)).fit(found).transform(found)
    return rounded(scaled, 6, *SIZED)


CODED = ("o_custkey", "o_orderpriority", "c_mktsegment")


def _coded_sql(column: str) -> str:
    return f"""SELECT coalesce(CAST({column} AS VARCHAR), '__MISSING__') AS value,
        count(*) / (SELECT count(*) FROM initial) AS frequency,
        row_number() OVER (ORDER BY min((o_orderdate, o_orderkey))) - 1 AS code
    FROM initial GROUP BY 1"""


GAPPY_PREDICTED_SQL = PREDICTED_SQL.replace(
    "SELECT o.*, c.c_nationkey",
    """SELECT o.* REPLACE (nullif(o.o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority),
        c.c_nationkey""",
)


FREQUENCY_SQL = f"""WITH {GAPPY_PREDICTED_SQL},
    {", ".join(f"t_{c} AS ({_coded_sql(c)})" for c in CODED)}
    SELECT o_orderkey, {", ".join(
        f"coalesce(CAST(t_{c}.code AS DOUBLE), -1) AS {c}, "
        f"round(coalesce(t_{c}.frequency, 0), 9) AS {c}_frequency" for c in CODED)}
    FROM validation v {" ".join(
        f"LEFT JOIN t_{c} ON t_{c}.value = coalesce(CAST(v.{c} AS VARCHAR), '__MISSING__')"
        for c in CODED)}"""


def _encoded(spark, folder, **how):
    unspecified = F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))
    initial, validation, _ = (
        part.withColumn("o_orderpriority", unspecified) if i < 2 else part
        for i, part in enumerate(split_fact(spark, folder))
    )
    order = row_order(F.col("o_orderdate"), F.col("o_orderkey").cast("long"))
    encoder = FrequencyEncoder(columns=list(CODED), **how)
    fitted = encoder.fit(initial.withColumn("_row_order", order))
    coded, names = fitted.transform(validation), fitted.output_names()
    shown = coded.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), *names)
    return rounded(shown, 9, *[n for n in names if n.endswith("_frequency")])


@query("frequency_encode", FREQUENCY_SQL)
def frequency_encode(spark, folder):
    """Codes learnt on the initial period, used on the validation period."""
    return _encoded(spark, folder)


@query("frequency_encode_shuffled", FREQUENCY_SQL)
def frequency_encode_shuffled(spark, folder):
    """The same by one join for all columns, as tables do that are too large to be broadcast."""
    return _encoded(spark, folder, broadcastBytes=0)


PREPROCESSED = ("c_acctbal", "o_orderdate_month", "c_mktsegment", "c_mktsegment_frequency")


@query(
    "preprocess",
    f"""WITH {PREDICTED_SQL}, t_segment AS ({_coded_sql("c_mktsegment")}),
    known AS (SELECT *, month(o_orderdate) AS m FROM initial),
    stats AS (
        SELECT avg(c_acctbal) AS a_mean, stddev_pop(c_acctbal) AS a_dev, avg(m) AS m_mean,
            stddev_pop(m) AS m_dev FROM known)
    SELECT o_orderkey, round((c_acctbal - a_mean) / a_dev + 1e-7, 6) AS c_acctbal,
        round((month(o_orderdate) - m_mean) / m_dev + 1e-7, 6) AS o_orderdate_month,
        CAST(t.code AS DOUBLE) AS c_mktsegment, round(t.frequency + 1e-7, 6) AS c_mktsegment_frequency
    FROM validation v CROSS JOIN stats LEFT JOIN t_segment t ON t.value = v.c_mktsegment""",
)
def preprocess(spark, folder):
    """The whole preprocessor; four elements of its vector are shown."""
    initial, validation, _ = split_fact(spark, folder)
    fitted = fit_preprocessor(training_rows(initial, ORDERS), ORDERS)
    names = vector_names(fitted.stages)
    made = fitted.transform(training_rows(validation, ORDERS)).select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"),
        vector_to_array("features").alias("v"),
    )
    shown = [F.col("v")[names.index(c)].alias(c) for c in PREPROCESSED]
    return rounded(made.select("o_orderkey", *shown), 6, *PREPROCESSED)


@query(
    "ridge",
    f"""WITH {PREDICTED_SQL},
    m AS (SELECT avg(c_acctbal) AS mx, stddev_pop(c_acctbal) AS sx FROM initial),
    s AS (
        SELECT covar_pop(o_totalprice, (c_acctbal - mx) / sx) * count(*)
            / (var_pop((c_acctbal - mx) / sx) * count(*) + 100) AS slope,
            avg(o_totalprice) AS level FROM initial, m)
    SELECT o_orderkey, round(level + slope * (c_acctbal - mx) / sx + 1e-7, 2) AS prediction
    FROM validation, m, s""",
)
def ridge(spark, folder):
    """One scaled feature, penalty 100."""
    return _on_balance(spark, folder, RidgeRegressor(alpha=100.0))


def _on_balance(spark, folder, estimator):
    initial, validation, _ = split_fact(spark, folder)
    scaler = MedianScaler(columns=["c_acctbal"]).fit(initial)
    vector = VectorAssembler(inputCols=["c_acctbal"], outputCol="features")
    prepare = PipelineModel([scaler, vector])
    rows = prepare.transform(initial).withColumn("label", F.col("o_totalprice"))
    model = estimator.fit(rows.select("features", "label"))
    predicted = model.transform(prepare.transform(validation)).select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"), "prediction"
    )
    return rounded(predicted, 2, "prediction")


@query(
    "sgd_scaled",
    f"""WITH {PREDICTED_SQL},
    m AS (SELECT avg(c_acctbal) AS mx, stddev_pop(c_acctbal) AS sx FROM initial),
    s AS (
        SELECT covar_pop(o_totalprice, (c_acctbal - mx) / sx)
            / (var_pop((c_acctbal - mx) / sx) + CAST(0.5 AS DOUBLE)) AS slope,
            avg(o_totalprice) AS level FROM initial, m)
    SELECT o_orderkey, round(level + slope * (c_acctbal - mx) / sx + 1e-7, 2) AS prediction
    FROM validation, m, s""",
)
def gradient_descent_scaled(spark, folder):
    """Gradient descent on one scaled feature ends where ridge has its closed form."""
    return _on_balance(spark, folder, GradientRegressor(alpha=0.5, tol=1e-12))


KNN_SQL = f"""WITH {PREDICTED_SQL},
    m AS (
        SELECT avg(c_acctbal) AS ma, stddev_pop(c_acctbal) AS sa,
            avg(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))) AS md,
            stddev_pop(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))) AS sd
        FROM initial),
    t AS (
        SELECT (c_acctbal - ma) / sa AS a, (datediff('day', DATE '1995-01-01',
            CAST(o_orderdate AS DATE)) - md) / sd AS d, o_totalprice AS label FROM initial, m),
    q AS (
        SELECT o_orderkey, (c_acctbal - ma) / sa AS a, (datediff('day', DATE '1995-01-01',
            CAST(o_orderdate AS DATE)) - md) / sd AS d FROM validation, m),
    near AS (
        SELECT o_orderkey, unnest(min({{'s': sqrt((q.a - t.a) * (q.a - t.a)
            + (q.d - t.d) * (q.d - t.d)), 'label': label}}, 8)) AS hit FROM q, t GROUP BY 1)
    SELECT o_orderkey, round(CASE WHEN min(hit.s) = 0
        THEN avg(hit.label) FILTER (WHERE hit.s = 0)
        ELSE sum(hit.label / nullif(hit.s, 0)) / sum(1 / nullif(hit.s, 0)) END + 1e-7, 3) AS prediction
    FROM near GROUP BY o_orderkey"""


@query("knn_blocks", KNN_SQL)
def knn_blocks(spark, folder):
    """The same with cells cut into blocks of rows and of queries, as for many rows."""
    return knn(spark, folder, cellRows=300, blockRows=100, queryRows=50)


@query("knn_regions", KNN_SQL)
def knn_regions(spark, folder):
    """The same with few regions, so that each is cut further by a tree of its own."""
    return knn(spark, folder, cellRows=100, blockRows=80, queryRows=40, regions=4)


@query("knn", KNN_SQL)
def knn(spark, folder, **sizes):
    """Eight nearest initial orders by balance and day."""
    initial, validation, _ = split_fact(spark, folder)
    at = F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")).cast("double")
    initial, validation = (part.withColumn("d", at) for part in (initial, validation))
    scaler = MedianScaler(columns=["c_acctbal", "d"]).fit(initial)
    vector = VectorAssembler(inputCols=["c_acctbal", "d"], outputCol="features")
    prepare = PipelineModel([scaler, vector])
    rows = prepare.transform(initial).withColumn("label", F.col("o_totalprice"))
    model = KnnRegressor(k=8, weights="distance", **sizes).fit(rows.select("features", "label"))
    asked = prepare.transform(validation).select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"), "features"
    )
    return rounded(model.transform(asked).select("o_orderkey", "prediction"), 3, "prediction")


@query(
    "batch_score",
    """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate,
        o_orderpriority, CAST(42 AS DOUBLE) AS predict FROM orders""",
)
def batch_score(spark, folder):
    """Orders without their price, scored by a constant model."""
    given = orders(spark, folder).drop("o_totalprice")
    given = given.withColumn("o_orderdate", F.to_date("o_orderdate"))
    model = PipelineModel([ConstantModel(value=42.0)])
    return score_rows(given, model, ORDERS, customers(spark, folder), "orders.parquet")


# Files of orders and, beside them, of customers; the day of an order is all a model learns from.
FILED = replace(
    ORDERS,
    roles=ColumnRoles(
        datetime=("o_orderdate",), ids=("o_orderkey",),
        service=("o_custkey", "o_orderstatus", "o_orderpriority", "note",
            "c_nationkey", "c_acctbal", "c_mktsegment"),
    ),
    dimension=replace(ORDERS.dimension, file_name="customer.csv"),
)


@query(
    "csv_round_trip",
    f"""WITH {PREDICTED_SQL}
    SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority,
        'said "' || o_orderstatus || '",' || chr(10) || ' twice' AS note, o_totalprice, c_mktsegment,
        round((SELECT avg(o_totalprice) FROM initial) + 1e-7, 4) AS predict
    FROM fact""",
)
def csv_round_trip(spark, folder):
    """Two CSV files of orders loaded with the customers beside them, and scored into a file of their own."""
    root = work_path(spark, "files")
    said = F.concat(F.lit('said "'), "o_orderstatus", F.lit('",\n twice'))
    unspecified = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    given = orders(spark, folder).withColumns(
        {"note": said, "o_orderpriority": F.when(unspecified, "NA").otherwise(F.col("o_orderpriority"))}
    )
    files = {"open.csv": F.col("o_orderstatus") == "O", "other.csv": F.col("o_orderstatus") != "O"}

    def write(frame, name):
        # Doubled quotes, as CSV has them.
        frame.write.options(header=True, quote='"', escape='"').csv(f"{root}/{name}")
        return f"{root}/{name}"

    paths = [write(given.where(of), name) for name, of in files.items()]
    write(customers(spark, folder), FILED.dimension.file_name)
    # Read by many jobs: the files are parsed and the customers joined once.
    source = settled(load_source(spark, paths, FILED))
    workspace = Workspace(spark, work_path(spark, "scoring"))
    pretrain(source, FILED, workspace, lambda name: MeanRegressor())
    unpriced = write(given.drop("o_totalprice"), "unpriced.csv")
    scored = spark.read.parquet(score_file(spark, unpriced, FILED, workspace))
    key = F.col("o_orderkey").cast("long").alias("o_orderkey")
    facts = source.select(key, F.col("o_totalprice").cast("double").alias("o_totalprice"), "c_mktsegment")
    made = scored.select(key, "o_orderpriority", "note", "predict").join(facts, "o_orderkey")
    return rounded(made, 4, "predict")


def _shown(predictions):
    return rounded(regression_metrics(predictions, with_pearson=True), 4, "rmse", "mae")


def _fitted_metrics(spark, folder, name):
    initial, validation, _ = split_fact(spark, folder)
    model = fit_model(initial, ORDERS, name)
    return _shown(predict(model, validation, ORDERS)).withColumn("model_name", F.lit(name))


def _best_split_sql(rows: str) -> str:
    """Of each node the feature and value after which a split leaves the least squared error."""
    return f"""SELECT node, arg_max(f, explained) AS f, arg_max(v, explained) AS v FROM (
        SELECT node, f, v, below_sum * below_sum / below + (total - below_sum) * (total - below_sum)
            / nullif(n - below, 0) AS explained
        FROM (
            SELECT node, f, v, sum(count(*)) OVER upto AS below, sum(sum(y)) OVER upto AS below_sum,
                sum(count(*)) OVER every AS n, sum(sum(y)) OVER every AS total
            FROM (
                SELECT node, 0 AS f, m AS v, y FROM {rows}
                UNION ALL SELECT node, 1, nation, y FROM {rows})
            GROUP BY node, f, v
            WINDOW upto AS (PARTITION BY node, f ORDER BY v), every AS (PARTITION BY node, f))
        WHERE below >= 10 AND n - below >= 10)
    GROUP BY node"""


@query(
    "decision_tree_splits",
    f"""WITH {PREDICTED_SQL},
    known AS (
        SELECT 1 AS node, month(o_orderdate) AS m, c_nationkey AS nation, o_totalprice AS y FROM initial),
    root AS ({_best_split_sql("known")}),
    halves AS (
        SELECT CASE WHEN CASE WHEN r.f = 0 THEN k.m ELSE k.nation END <= r.v THEN 2 ELSE 3 END AS node,
            k.m, k.nation, k.y
        FROM known k, root r),
    second AS ({_best_split_sql("halves")}),
    leaves AS (
        SELECT h.node, CASE WHEN s.f = 0 THEN h.m ELSE h.nation END <= s.v AS below, avg(h.y) AS prediction
        FROM halves h LEFT JOIN second s ON s.node = h.node GROUP BY ALL),
    asked AS (
        SELECT v.o_orderkey, month(v.o_orderdate) AS m, v.c_nationkey AS nation,
            CASE WHEN CASE WHEN r.f = 0 THEN month(v.o_orderdate) ELSE v.c_nationkey END <= r.v
                THEN 2 ELSE 3 END AS node
        FROM validation v, root r)
    SELECT a.o_orderkey, round(l.prediction + 1e-7, 4) AS prediction
    FROM asked a LEFT JOIN second s ON s.node = a.node
    JOIN leaves l ON l.node = a.node
        AND l.below IS NOT DISTINCT FROM (CASE WHEN s.f = 0 THEN a.m ELSE a.nation END <= s.v)""",
)
def decision_tree_splits(spark, folder):
    """A tree of depth two on month and nation, whose every possible split SQL searches by itself."""
    initial, validation, _ = split_fact(spark, folder)
    vector = VectorAssembler(inputCols=["m", "c_nationkey"], outputCol="features")

    def prepared(part):
        month = F.month(F.to_date("o_orderdate"))
        return vector.transform(part.withColumns({"m": month, "label": F.col("o_totalprice").cast("double")}))

    tree = make_estimator("decision_tree", {"max_depth": 2, "min_samples_leaf": 10}, seed=1)
    made = tree.fit(prepared(initial)).transform(prepared(validation))
    shown = made.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "prediction")
    return rounded(shown, 4, "prediction")


@query("decision_tree")
def decision_tree(spark, folder):
    return _fitted_metrics(spark, folder, "decision_tree_regression")


@query("random_forest")
def random_forest(spark, folder):
    return _fitted_metrics(spark, folder, "random_forest_regression")


@query("sgd_regression")
def gradient_descent(spark, folder):
    return _fitted_metrics(spark, folder, "sgd_regression")


@query("batch_score_tree")
def batch_score_tree(spark, folder):
    """All orders scored by a tree trained on the initial period."""
    initial, _, _ = split_fact(spark, folder)
    model = fit_model(initial, ORDERS, "decision_tree_regression")
    return score_rows(orders(spark, folder), model, ORDERS, customers(spark, folder))


@query("multi_model")
def multi_model(spark, folder):
    """Baselines and every candidate on the same split, best first."""
    return evaluate(fact(spark, folder), ORDERS).leaderboard()


@query("best_timeline")
def best_timeline(spark, folder):
    return evaluate(fact(spark, folder), ORDERS).best_timeline()


@query("pretrain")
def pretrained(spark, folder):
    return pretrain(fact(spark, folder), ORDERS).metrics


@query("top_features")
def weights(spark, folder):
    initial, _, _ = split_fact(spark, folder)
    rows = training_rows(initial, ORDERS).persist()
    prepare = FeaturePreprocessor.for_table(initial.columns, ORDERS).fit(rows)
    tree = estimator_for(ORDERS.model, "decision_tree").fit(prepare.transform(rows))
    rows.unpersist()
    return top_features(spark, tree, vector_names(prepare.stages))


@query("first_features")
def first_weights(spark, folder):
    """The five features that weigh most."""
    return weights(spark, folder).orderBy(F.desc("abs_value"), "feature").limit(5)


