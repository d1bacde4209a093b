"""Reading, joining, parsing, typing and treating targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.functions.columns import iso_day, number
from tillcast.operators.clean import (
    apply_types,
    clean_serving,
    clean_training,
    drop_leakage,
    parse_time,
    treat_target,
)
from tillcast.operators.features import build_features
from tillcast.operators.lookup import enrich
from tillcast.params import ColumnRoles, JobParams
from tillcast.queries.data import (
    FACT_SQL,
    GAPPY_SQL,
    ORDERS,
    customers,
    fact,
    gappy,
    orders,
    table,
    with_target,
)
from tillcast.queries.registry import query
from tillcast.sources.files import read_sources


@query("left_enrich", f"WITH {FACT_SQL} SELECT * FROM fact")
def left_enrich(spark, folder):
    return fact(spark, folder)


@query("left_enrich_salted", f"WITH {FACT_SQL} SELECT * FROM fact")
def left_enrich_salted(spark, folder):
    """The same without a broadcast: hot keys salted, both sides shuffled."""
    found = orders(spark, folder)
    return enrich(found, customers(spark, folder), ORDERS.dimension, broadcast_bytes=0)


@query(
    "union_sources",
    """WITH united AS (
        SELECT o_custkey AS buyer, NULL AS part, o_orderdate AS sold_at, o_totalprice AS amount,
            'orders.parquet' AS source FROM orders
        UNION ALL
        SELECT NULL, l_partkey, l_shipdate, l_extendedprice, 'lineitem.parquet' FROM lineitem)
    SELECT source, CAST(year(sold_at) AS INTEGER) AS year, count(*) AS rows, count(buyer) AS buyers,
        count(part) AS parts, round(CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) + 1e-7, 2)
            AS amount
    FROM united GROUP BY ALL""",
)
def union_sources(spark, folder):
    paths = [f"{folder}/orders.parquet", f"{folder}/lineitem.parquet"]
    named = {
        paths[0]: {
            "buyer": F.col("o_custkey"),
            "sold_at": F.col("o_orderdate"),
            "amount": F.col("o_totalprice"),
        },
        paths[1]: {
            "part": F.col("l_partkey"),
            "sold_at": F.col("l_shipdate"),
            "amount": F.col("l_extendedprice"),
        },
    }
    united = read_sources(spark, paths, columns=named)
    total = F.sum(F.col("amount").cast("decimal(18,2)")).cast("double")
    return united.groupBy(F.col("_source_file").alias("source"), F.year("sold_at").alias("year")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("buyer").alias("buyers"),
        F.count("part").alias("parts"),
        F.round(total, 2).alias("amount"),
    )


def _mixed_text(spark, folder):
    """Texts of which only some are numbers or dates."""
    final = F.col("o_orderstatus") == "F"
    return orders(spark, folder).select(
        "o_orderkey",
        F.when(final, F.col("o_totalprice").cast("string"))
        .otherwise(F.col("o_orderpriority"))
        .alias("amount"),
        F.when(F.col("o_orderstatus") != "P", iso_day(F.col("o_orderdate")))
        .otherwise(F.col("o_orderpriority"))
        .alias("placed_at"),
        F.when(final, iso_day(F.col("o_orderdate")))
        .otherwise(F.lit("unknown"))
        .alias("closed_at"),
    )


MIXED_SQL = """mixed AS (
    SELECT o_orderkey,
        CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS VARCHAR)
            ELSE o_orderpriority END AS amount,
        CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d')
            ELSE o_orderpriority END AS placed_at,
        CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
            ELSE 'unknown' END AS closed_at
    FROM orders)"""


@query(
    "coerce_numeric",
    f"WITH {MIXED_SQL} SELECT o_orderkey, TRY_CAST(amount AS DOUBLE) AS amount FROM mixed",
)
def coerce_numeric(spark, folder):
    found = _mixed_text(spark, folder)
    return found.select("o_orderkey", number(found, "amount").alias("amount"))


@query(
    "parse_dates",
    f"""WITH {MIXED_SQL}
    SELECT o_orderkey, TRY_CAST(placed_at AS DATE) AS placed_at,
        TRY_CAST(closed_at AS DATE) AS closed_at
    FROM mixed WHERE TRY_CAST(placed_at AS DATE) IS NOT NULL""",
)
def parse_dates(spark, folder):
    params = JobParams(
        time_column="placed_at", roles=ColumnRoles(datetime=("placed_at", "closed_at"))
    )
    parsed = _mixed_text(spark, folder).transform(parse_time, params)
    return parsed.transform(apply_types, params).select(
        "o_orderkey", F.to_date("placed_at").alias("placed_at"), F.to_date("closed_at").alias("closed_at")
    )


@query(
    "drop_leakage",
    """SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, 'orders.parquet' AS _source_file
    FROM orders""",
)
def drop_leakage_columns(spark, folder):
    tagged = orders(spark, folder).withColumn("_source_file", F.col("_metadata.file_name"))
    service = ("o_orderstatus", "o_orderpriority", "_source_file")
    return drop_leakage(tagged, JobParams(roles=ColumnRoles(service=service)))


FEATURES_SQL = """CAST(c_acctbal AS DOUBLE) AS c_acctbal,
    CAST(c_nationkey AS DOUBLE) AS c_nationkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
    o_orderstatus, o_orderpriority, c_mktsegment,
    CAST(year(o_orderdate) AS DOUBLE) AS o_orderdate_year,
    CAST(month(o_orderdate) AS DOUBLE) AS o_orderdate_month,
    CAST(quarter(o_orderdate) AS DOUBLE) AS o_orderdate_quarter,
    CAST(day(o_orderdate) AS DOUBLE) AS o_orderdate_day,
    CAST(week(o_orderdate) AS DOUBLE) AS o_orderdate_weekofyear"""


@query("feature_projection", f"WITH {GAPPY_SQL} SELECT {FEATURES_SQL} FROM gappy")
def feature_projection(spark, folder):
    return build_features(gappy(spark, folder), ORDERS)


@query(
    "calendar_features",
    """SELECT l_orderkey, l_linenumber,
        CAST(year(l_shipdate) AS DOUBLE) AS l_shipdate_year,
        CAST(month(l_shipdate) AS DOUBLE) AS l_shipdate_month,
        CAST(quarter(l_shipdate) AS DOUBLE) AS l_shipdate_quarter,
        CAST(day(l_shipdate) AS DOUBLE) AS l_shipdate_day,
        CAST(week(l_shipdate) AS DOUBLE) AS l_shipdate_weekofyear
    FROM lineitem""",
)
def calendar_features(spark, folder):
    params = JobParams(time_column="l_shipdate")
    keep = ["l_orderkey", "l_linenumber"]
    return build_features(table(spark, folder, "lineitem"), params, keep)


CLEANED_SQL = """CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
    o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice, o_orderpriority,
    CAST(c_nationkey AS DOUBLE) AS c_nationkey, c_acctbal, c_mktsegment"""


@query(
    "clean_training",
    f"WITH {GAPPY_SQL} SELECT {CLEANED_SQL} FROM gappy WHERE o_totalprice IS NOT NULL",
)
def cleaned_for_training(spark, folder):
    cleaned = clean_training(gappy(spark, folder), ORDERS)
    return cleaned.withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("clean_serving", f"WITH {GAPPY_SQL} SELECT {CLEANED_SQL} FROM gappy")
def cleaned_for_serving(spark, folder):
    cleaned = clean_serving(gappy(spark, folder), ORDERS)
    return cleaned.withColumn("o_orderdate", F.to_date("o_orderdate"))


def _target(spark, folder, params):
    treated = treat_target(gappy(spark, folder), params)
    shown = ["o_orderkey", "o_totalprice"]
    if params.target.add_indicator:
        shown.append(params.indicator_column)
    return treated.select(*shown)


@query(
    "target_drop",
    f"WITH {GAPPY_SQL} SELECT o_orderkey, o_totalprice FROM gappy WHERE o_totalprice IS NOT NULL",
)
def target_drop(spark, folder):
    return _target(spark, folder, with_target("drop"))


@query(
    "target_fill",
    f"""WITH {GAPPY_SQL}
    SELECT o_orderkey, coalesce(o_totalprice, CAST(99.5 AS DOUBLE)) AS o_totalprice FROM gappy""",
)
def target_fill(spark, folder):
    return _target(spark, folder, with_target("fill_value", 99.5))


@query(
    "target_fill_zero",
    f"""WITH {GAPPY_SQL}
    SELECT o_orderkey, coalesce(o_totalprice, CAST(0 AS DOUBLE)) AS o_totalprice FROM gappy""",
)
def target_fill_zero(spark, folder):
    return _target(spark, folder, with_target("fill_zero"))


@query(
    "target_indicator",
    f"""WITH {GAPPY_SQL}
    SELECT o_orderkey, o_totalprice,
        CAST(o_totalprice IS NULL AS INTEGER) AS "o_totalprice_WAS_MISSING"
    FROM gappy""",
)
def target_indicator(spark, folder):
    return _target(spark, folder, with_target("keep", indicator=True))


