"""The tables behind the queries and the column roles they are used with."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillcast.functions.columns import moment
from tillcast.operators.lookup import enrich, lookup_join, lookup_profile
from tillcast.operators.clean import clean_training
from tillcast.operators.periods import Split, calendar, period_rows, split_periods
from tillcast.params import ColumnRoles, DimensionParams, JobParams, ModelParams, TargetParams

ORDERS = JobParams(
    time_column="o_orderdate",
    target_column="o_totalprice",
    leakage_columns=(),
    roles=ColumnRoles(
        numeric=("c_acctbal", "c_nationkey"),
        categorical=("o_custkey", "o_orderstatus", "o_orderpriority", "c_mktsegment"),
        datetime=("o_orderdate",),
        ids=("o_orderkey",),
    ),
    dimension=DimensionParams(key="o_custkey", check_column="c_mktsegment"),
    model=ModelParams(
        candidate_models=("decision_tree", "random_forest", "knn", "ridge"),
        training_mode="all",
        parameters={
            "decision_tree": {"min_samples_leaf": 10},
            "random_forest": {"n_estimators": 100, "max_depth": 20, "min_samples_leaf": 10},
            "knn": {"n_neighbors": 8, "weights": "distance"},
            "ridge": {"alpha": 1.0},
            "sgd": {"alpha": 0.0001, "max_iter": 1000, "tol": 0.001},
        },
    ),
)

LINEITEM = JobParams(
    time_column="l_shipdate",
    target_column="l_extendedprice",
    leakage_columns=(),
    roles=ColumnRoles(
        numeric=("l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"),
        categorical=("l_returnflag", "l_linestatus", "p_brand", "p_type"),
        datetime=("l_shipdate",),
        ids=("l_orderkey", "l_linenumber"),
    ),
    dimension=DimensionParams(key="l_partkey", check_column="p_brand"),
)

EVENTS = JobParams(
    time_column="ts",
    target_column="value",
    leakage_columns=(),
    roles=ColumnRoles(
        categorical=("event_type",),
        datetime=("ts",),
        ids=("event_id",),
        service=("user_id", "props"),
    ),
    model=ModelParams(
        candidate_models=("ridge", "sgd"), training_mode="single", selected_model="ridge"
    ),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment"
    )


def fact(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer."""
    return enrich(orders(spark, folder), customers(spark, folder), ORDERS.dimension)


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their part."""
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_size", "p_retailprice"
    )
    return enrich(table(spark, folder, "lineitem"), parts, LINEITEM.dimension)


def gappy(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in which an unspecified priority and the price of a pending order are missing."""
    return fact(spark, folder).withColumns(
        {
            "o_orderpriority": F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")),
            "o_totalprice": F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")),
        }
    )


def with_target(strategy: str, fill: float = 0.0, indicator: bool = False) -> JobParams:
    return replace(ORDERS, target=TargetParams(strategy, fill, indicator))


def split_fact(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, Split]:
    """Cleaned initial and validation rows of the orders."""
    cleaned = clean_training(fact(spark, folder), ORDERS)
    split = split_periods(orders(spark, folder), ORDERS)
    initial = period_rows(cleaned, ORDERS, split, "initial")
    return initial, period_rows(cleaned, ORDERS, split, "validation"), split


def segment_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Validation orders predicted by the mean initial price of their market segment."""
    initial, validation, _ = split_fact(spark, folder)
    means = initial.groupBy("c_mktsegment").agg(F.avg("o_totalprice").alias("prediction"))
    _, _, size = lookup_profile(means, "c_mktsegment")
    joined = lookup_join(validation, means, "c_mktsegment", size)
    return joined.select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"),
        "o_orderdate",
        F.col("o_totalprice").alias("actual"),
        "prediction",
    )


def batch_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Stream orders, by batch, under three constant or near-constant predictors."""
    found = fact(spark, folder)
    days = calendar(orders(spark, folder), ORDERS)
    split = split_periods(orders(spark, folder), ORDERS)
    initial = period_rows(found, ORDERS, split, "initial")
    mean = initial.agg(F.avg("o_totalprice")).scalar()
    means = initial.groupBy("c_mktsegment").agg(F.avg("o_totalprice").alias("segment_mean"))
    _, _, size = lookup_profile(means, "c_mktsegment")
    stream = period_rows(found, ORDERS, split, "stream")
    stream = stream.withColumn("day", F.to_date(moment(stream, "o_orderdate")))
    # One row per day, see the period operators.
    placed = stream.join(F.broadcast(days.select("day", "batch_id")), "day")
    predicted = lookup_join(placed, means, "c_mktsegment", size).select(
        "batch_id",
        "day",
        F.col("o_totalprice").alias("actual"),
        F.lit(0.0).alias("zero_baseline"),
        mean.alias("mean_baseline"),
        F.col("segment_mean"),
    )
    return predicted.unpivot(
        ["batch_id", "day", "actual"],
        ["zero_baseline", "mean_baseline", "segment_mean"],
        "model_name",
        "prediction",
    )


FACT_SQL = """fact AS (
    SELECT o.*, c.c_nationkey, c.c_acctbal, c.c_mktsegment
    FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey)"""

GAPPY_SQL = """gappy AS (
    SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate,
        CASE WHEN o.o_orderstatus <> 'P' THEN o.o_totalprice END AS o_totalprice,
        nullif(o.o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority,
        c.c_nationkey, c.c_acctbal, c.c_mktsegment
    FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey)"""

LINES_SQL = """lines AS (
    SELECT l.*, p.p_brand, p.p_type, p.p_size, p.p_retailprice
    FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey)"""


def calendar_sql(source: str = "orders", column: str = "o_orderdate", batch_days: int = 7) -> str:
    return f"""days AS (SELECT DISTINCT CAST({column} AS DATE) AS day FROM {source}),
numbered AS (
    SELECT day, CAST(row_number() OVER (ORDER BY day) - 1 AS BIGINT) AS ord,
        count(*) OVER () AS n FROM days),
sized AS (
    SELECT *, greatest(CAST(floor(n * CAST(0.5 AS DOUBLE)) AS BIGINT), 1) AS initial_n,
        greatest(CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT), 1) AS wanted_n FROM numbered),
split AS (
    SELECT *, initial_n + CASE WHEN initial_n + wanted_n >= n
        THEN greatest(n - initial_n - 1, 1) ELSE wanted_n END AS start_n FROM sized),
cal AS (
    SELECT day, ord,
        CASE WHEN ord < initial_n THEN 'initial' WHEN ord < start_n THEN 'validation'
            ELSE 'stream' END AS period,
        CASE WHEN ord >= start_n THEN CAST((ord - start_n) // {batch_days} AS BIGINT)
            END AS batch_id
    FROM split)"""


PREDICTED_SQL = f"""{FACT_SQL}, {calendar_sql()},
initial AS (
    SELECT f.* FROM fact f JOIN cal ON cal.day = CAST(f.o_orderdate AS DATE)
    WHERE cal.period = 'initial'),
validation AS (
    SELECT f.* FROM fact f JOIN cal ON cal.day = CAST(f.o_orderdate AS DATE)
    WHERE cal.period = 'validation'),
segment AS (SELECT c_mktsegment, avg(o_totalprice) AS prediction FROM initial GROUP BY 1),
predicted AS (
    SELECT v.o_orderkey, v.o_orderdate, v.o_totalprice AS actual, s.prediction
    FROM validation v LEFT JOIN segment s ON s.c_mktsegment = v.c_mktsegment)"""

BATCHED_SQL = f"""{FACT_SQL}, {calendar_sql()},
placed AS (
    SELECT f.*, cal.day, cal.period, cal.batch_id
    FROM fact f JOIN cal ON cal.day = CAST(f.o_orderdate AS DATE)),
segment AS (
    SELECT c_mktsegment, avg(o_totalprice) AS prediction FROM placed
    WHERE period = 'initial' GROUP BY 1),
batched AS (
    SELECT batch_id, day, o_totalprice AS actual, 'zero_baseline' AS model_name,
        CAST(0 AS DOUBLE) AS prediction FROM placed WHERE period = 'stream'
    UNION ALL
    SELECT batch_id, day, o_totalprice, 'mean_baseline',
        (SELECT avg(o_totalprice) FROM placed WHERE period = 'initial')
    FROM placed WHERE period = 'stream'
    UNION ALL
    SELECT p.batch_id, p.day, p.o_totalprice, 'segment_mean', s.prediction
    FROM placed p LEFT JOIN segment s ON s.c_mktsegment = p.c_mktsegment
    WHERE p.period = 'stream')"""


def metrics_sql(actual: str = "actual", prediction: str = "prediction") -> str:
    """The metric columns as SQL, clipped predictions assumed."""
    y, p = actual, prediction
    return f"""sqrt(avg(({p} - {y}) * ({p} - {y}))) AS rmse,
        avg(abs({p} - {y})) AS mae,
        CASE WHEN var_pop({y}) > 0
            THEN 1 - sum(({p} - {y}) * ({p} - {y})) / (count(*) * var_pop({y}))
            WHEN sum(abs({p} - {y})) = 0 THEN 1.0 ELSE 0.0 END AS r2,
        avg(CASE WHEN abs({y}) + abs({p}) = 0 THEN 0
            ELSE 2 * abs({p} - {y}) / (abs({y}) + abs({p})) END) AS smape,
        avg({y}) AS target_mean, avg({p}) AS prediction_mean"""


# Engines add up in different orders. The nudge, which the SQL twins repeat, keeps a value that
# lies exactly between two roundings from going either way.
NUDGE = 1e-7


def rounded(frame: DataFrame, digits: int, *columns: str) -> DataFrame:
    nudge = NUDGE if digits <= 6 else 0.0
    return frame.withColumns({c: F.round(F.col(c) + F.lit(nudge), digits) for c in columns})
