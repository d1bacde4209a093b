"""Data quality and batch metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.functions.columns import sorted_json
from tillcast.operators.periods import calendar
from tillcast.operators.quality import (
    SKETCHES,
    batch_metadata,
    cardinality,
    column_profile,
    constant_columns,
    distinct_sketches,
    duplicate_rows,
    iqr_outliers,
    merged_cardinality,
    missing_part,
    outlier_columns,
    quality_report,
    schema_drift,
    source_profile,
)
from tillcast.queries.data import (
    EVENTS,
    GAPPY_SQL,
    LINEITEM,
    LINES_SQL,
    ORDERS,
    calendar_sql,
    gappy,
    lines,
    orders,
    rounded,
    table,
)
from tillcast.operators.quantiles import DIRECT_ROWS
from tillcast.queries.registry import query
from tillcast.session import work_path
from tillcast.sources.tables import KeyedTable

FACT_COLUMNS = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
    "o_orderpriority", "c_nationkey", "c_acctbal", "c_mktsegment",
)


def _nulls(columns=FACT_COLUMNS) -> str:
    return " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in columns)


@query(
    "missing_part",
    f"""WITH {GAPPY_SQL}
    SELECT count(*) AS rows, CAST(sum({_nulls()}) AS BIGINT) AS missing_cells,
        round(sum({_nulls()}) / (count(*) * {len(FACT_COLUMNS)}), 9) AS missing_part
    FROM gappy""",
)
def missing(spark, folder):
    return rounded(missing_part(gappy(spark, folder)), 9, "missing_part")


COPIES_SQL = """copies AS (
    SELECT l_returnflag, l_linestatus, nullif(l_discount, 0) AS l_discount, l_quantity,
        year(l_shipdate) AS ship_year FROM lineitem)"""


@query(
    "duplicates",
    f"""WITH {COPIES_SQL}, kept AS (SELECT DISTINCT * FROM copies)
    SELECT (SELECT count(*) FROM copies) AS rows,
        (SELECT count(*) FROM copies) - (SELECT count(*) FROM kept) AS duplicate_rows,
        round(CAST((SELECT count(*) FROM copies) - (SELECT count(*) FROM kept) AS DOUBLE)
            / (SELECT count(*) FROM copies), 9) AS duplicate_part""",
)
def duplicates(spark, folder):
    found = table(spark, folder, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        "l_quantity",
        F.year("l_shipdate").alias("ship_year"),
    )
    return rounded(duplicate_rows(found), 9, "duplicate_part")


def _with_constants(spark, folder):
    """Events with a tag, an empty column and a flag that is either one value or null."""
    return table(spark, folder, "events").select(
        "event_id",
        "event_type",
        F.year("ts").alias("year"),
        F.col("_metadata.file_name").alias("source"),
        F.lit(None).cast("string").alias("empty"),
        F.when(F.col("event_type") == "purchase", F.lit("yes")).alias("bought"),
    )


def _constant_sql() -> str:
    columns = ("event_id", "event_type", "year", "source", "empty", "bought")
    parts = [
        f"""SELECT '{c}' AS "column" FROM tagged
        HAVING count(DISTINCT {c}) + max(CAST({c} IS NULL AS INTEGER)) <= 1"""
        for c in columns
    ]
    return f"""WITH tagged AS (
        SELECT event_id, event_type, year(ts) AS year, 'events.parquet' AS source,
            CAST(NULL AS VARCHAR) AS empty,
            CASE WHEN event_type = 'purchase' THEN 'yes' END AS bought FROM events)
    {" UNION ALL ".join(parts)}"""


@query("constant_columns", _constant_sql())
def constants(spark, folder):
    return constant_columns(_with_constants(spark, folder))


def _cardinality_sql(columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS unique_values FROM gappy"""
        for c in columns
    )


@query("cardinality", f"WITH {GAPPY_SQL} {_cardinality_sql(ORDERS.roles.categorical)}")
def category_cardinality(spark, folder):
    return cardinality(gappy(spark, folder), ORDERS.roles.categorical)


SKETCHED = ("event_type", "user_id", "event_id")


@query(
    "cardinality_merged",
    f"""WITH {calendar_sql("events", "ts")}, placed AS (
        SELECT e.*, coalesce(cal.batch_id, -1) AS batch_id
        FROM events e JOIN cal ON cal.day = CAST(e.ts AS DATE))
    {" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS unique_values,
            count(DISTINCT batch_id) AS batches, TRUE AS within FROM placed""" for c in SKETCHED)}""",
)
def cardinality_merged(spark, folder):
    """Sketches stored per batch and merged, against exact counts: within five per cent, three deviations."""
    events = table(spark, folder, "events")
    days = calendar(events, EVENTS).select("day", F.coalesce("batch_id", F.lit(-1)).alias("batch_id"))
    placed = events.withColumn("day", F.to_date("ts")).join(F.broadcast(days), "day")
    stored = KeyedTable(spark, work_path(spark, "sketches"))
    stored.write(distinct_sketches(placed, SKETCHED, ["batch_id"]))
    sketches = stored.read(SKETCHES)
    batches = sketches.groupBy("column").agg(F.count_distinct("batch_id").alias("batches"))
    about = merged_cardinality(sketches).withColumnRenamed("unique_values", "about")
    within = F.abs(F.col("about") - F.col("unique_values")) <= 0.05 * F.col("unique_values")
    exact = cardinality(events, SKETCHED).join(about, "column").join(batches, "column")
    return exact.select("column", "unique_values", "batches", within.alias("within"))


def _outlier_sql(source: str, columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "values",
            count(*) FILTER (WHERE q3 <> q1 AND
                ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))) AS outliers
        FROM {source}, (SELECT quantile_cont({c}, CAST(0.25 AS DOUBLE)) AS q1,
            quantile_cont({c}, CAST(0.75 AS DOUBLE)) AS q3 FROM {source})"""
        for c in columns
    )


PRICED_SQL = """priced AS (
    SELECT l.l_extendedprice, l.l_quantity, l.l_tax, l.l_discount,
        l.l_extendedprice * l.l_quantity * l.l_discount AS weight, p.p_retailprice, p.p_size
    FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey)"""
PRICED = (
    "l_extendedprice", "l_quantity", "l_tax", "l_discount", "weight", "p_retailprice", "p_size",
)


OUTLIERS_SQL = f"""WITH {PRICED_SQL}, found AS ({_outlier_sql("priced", PRICED)})
    SELECT "column", "values", outliers, round(outliers / "values", 9) AS outlier_part,
        round((SELECT sum(outliers) / sum("values") FROM found), 9) AS numeric_outlier_part
    FROM found"""


@query("iqr_outliers_narrowed", OUTLIERS_SQL)
def outliers_narrowed(spark, folder):
    """The same by narrowing brackets, as for more values than a task sorts."""
    return outliers(spark, folder, direct_rows=500)


@query("iqr_outliers", OUTLIERS_SQL)
def outliers(spark, folder, direct_rows=DIRECT_ROWS):
    weight = F.col("l_extendedprice") * F.col("l_quantity") * F.col("l_discount")
    found = lines(spark, folder).withColumn("weight", weight).select(*PRICED)
    return rounded(iqr_outliers(found, PRICED, direct_rows), 9, "outlier_part", "numeric_outlier_part")


@query(
    "schema_drift",
    """WITH there AS (SELECT column_name FROM (DESCRIBE orders)),
    expected AS (SELECT unnest(['o_orderdate', 'o_totalprice', 'c_acctbal', 'c_nationkey',
        'o_custkey', 'o_orderstatus', 'o_orderpriority', 'c_mktsegment']) AS column_name)
    SELECT column_name AS "column", 'missing' AS kind
    FROM (SELECT * FROM expected EXCEPT SELECT * FROM there)
    UNION ALL SELECT column_name, 'extra' FROM (SELECT * FROM there EXCEPT SELECT * FROM expected)""",
)
def drift(spark, folder):
    """Plain orders against the columns that training on enriched orders expects."""
    return schema_drift(orders(spark, folder), ORDERS)


def _profile_sql() -> str:
    kinds = {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    }
    parts = [
        f"""SELECT '{c}' AS "column", '{kind}' AS dtype,
            round(1 - count({c}) / count(*), 9) AS missing_part,
            count(DISTINCT {c}) AS unique_values FROM gappy"""
        for c, kind in kinds.items()
    ]
    return f"WITH {GAPPY_SQL} {' UNION ALL '.join(parts)}"


@query("column_profile", _profile_sql())
def profile(spark, folder):
    return rounded(column_profile(gappy(spark, folder)), 9, "missing_part")


@query(
    "source_profile",
    f"""WITH {GAPPY_SQL}
    SELECT count(*) AS rows, {len(FACT_COLUMNS)} AS features, 4 AS categorical_features,
        true AS has_time_column, true AS has_target_column,
        round(sum({_nulls()}) / (count(*) * {len(FACT_COLUMNS)}), 9) AS missing_part,
        strftime(min(o_orderdate), '%Y-%m-%d') AS time_min,
        strftime(max(o_orderdate), '%Y-%m-%d') AS time_max
    FROM gappy""",
)
def profiled_source(spark, folder):
    return rounded(source_profile(gappy(spark, folder), ORDERS), 9, "missing_part")


EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


@query(
    "batch_metadata",
    f"""WITH {calendar_sql("events", "ts")},
    placed AS (
        SELECT e.*, cal.batch_id FROM events e JOIN cal ON cal.day = CAST(e.ts AS DATE)
        WHERE cal.batch_id IS NOT NULL)
    SELECT batch_id, count(*) AS rows, {len(EVENT_COLUMNS)} AS "columns",
        CAST(0 AS BIGINT) AS start_row, count(*) AS end_row,
        strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS time_min,
        strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS time_max,
        round(sum({_nulls(EVENT_COLUMNS)}) / (count(*) * {len(EVENT_COLUMNS)}), 9)
            AS missing_part,
        0 AS numeric_features, 1 AS categorical_features,
        count(*) FILTER (WHERE value IS NULL) AS target_missing,
        round(avg(value) + 1e-7, 6) AS target_mean, min(value) AS target_min, max(value) AS target_max,
        'drop' AS target_missing_strategy, '' AS target_missing_indicator_column,
        strftime(min(ts), '%Y-%m-%d') AS date_min, strftime(max(ts), '%Y-%m-%d') AS date_max,
        count(DISTINCT CAST(ts AS DATE)) AS date_count
    FROM placed GROUP BY batch_id""",
)
def metadata(spark, folder):
    events = table(spark, folder, "events")
    days = calendar(events, EVENTS).where("batch_id is not null").select("day", "batch_id")
    placed = (
        events.withColumn("day", F.to_date("ts")).join(F.broadcast(days), "day").drop("day")
    )
    made = batch_metadata(placed, EVENTS, by=["batch_id"])
    return rounded(rounded(made, 9, "missing_part"), 6, "target_mean")


LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "p_brand", "p_type",
    "p_size", "p_retailprice",
)


def _report_sql() -> str:
    numeric = outlier_columns(LINEITEM)
    shares = ", ".join(
        f"""(SELECT outliers / "values" FROM found WHERE "column" = '{c}')"""
        for c in sorted(numeric)
    )
    counts = " || ',' || ".join(
        f"""'"{c}":' || count(DISTINCT {c})""" for c in sorted(LINEITEM.roles.categorical)
    )
    return f"""WITH {LINES_SQL}, found AS ({_outlier_sql("lines", numeric)}),
    kept AS (SELECT DISTINCT * FROM lines)
    SELECT count(*) AS rows, {len(LINE_COLUMNS)} AS "columns",
        strftime(min(l_shipdate), '%Y-%m-%d') AS date_min,
        strftime(max(l_shipdate), '%Y-%m-%d') AS date_max,
        strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S') AS time_min,
        strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS time_max,
        round(sum({_nulls(LINE_COLUMNS)}) / (count(*) * {len(LINE_COLUMNS)}), 9) AS missing_part,
        count(*) - (SELECT count(*) FROM kept) AS duplicate_rows,
        round(CAST(count(*) - (SELECT count(*) FROM kept) AS DOUBLE) / count(*), 9)
            AS duplicate_part,
        '' AS constant_columns, '' AS schema_missing_columns,
        'l_orderkey,l_partkey,l_suppkey,l_linenumber' AS schema_extra_columns,
        round((SELECT sum(outliers) / sum("values") FROM found), 9) AS numeric_outlier_part,
        round(list_sum([{shares}]), 9) AS outlier_part_sum,
        '{{' || {counts} || '}}' AS category_cardinality
    FROM lines"""


@query("quality_report", _report_sql())
def report(spark, folder):
    made = quality_report(lines(spark, folder), LINEITEM)
    total = F.aggregate(
        F.map_values("numeric_outlier_columns"), F.lit(0.0), lambda acc, v: acc + v
    )
    listed = ("constant_columns", "schema_missing_columns", "schema_extra_columns")
    shown = made.withColumns(
        {
            "outlier_part_sum": F.round(total, 9),
            "category_cardinality": sorted_json(F.col("category_cardinality")),
            **{name: F.array_join(name, ",") for name in listed},
        }
    ).drop("numeric_outlier_columns")
    return rounded(shown, 9, "missing_part", "duplicate_part", "numeric_outlier_part")
