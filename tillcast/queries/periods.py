"""The date split, its batches and the rows it selects."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tillcast.operators.periods import (
    boundaries,
    calendar,
    known_rows,
    period_rows,
    rolling_rows,
    rows_for_days,
    split_periods,
    stream_batches,
    window_metadata,
)
from tillcast.queries.data import ORDERS, calendar_sql, orders
from tillcast.queries.registry import query

PERIODS = ("initial", "validation", "stream")


@query("period_split", f"WITH {calendar_sql()} SELECT day, ord, period FROM cal")
def period_split(spark, folder):
    return calendar(orders(spark, folder), ORDERS).drop("batch_id")


def _boundary_sql() -> str:
    fields = []
    for period in PERIODS:
        for name, pick in (("min", "min"), ("max", "max")):
            fields.append(
                f"coalesce(strftime({pick}(day) FILTER (WHERE period = '{period}'), '%Y-%m-%d'), "
                f"'') AS {period}_date_{name}"
            )
        fields.append(f"count(*) FILTER (WHERE period = '{period}') AS {period}_date_count")
    return f"WITH {calendar_sql()} SELECT {', '.join(fields)} FROM cal"


@query("period_boundaries", _boundary_sql())
def period_boundaries(spark, folder):
    return boundaries(calendar(orders(spark, folder), ORDERS))


@query(
    "period_rows",
    f"""WITH {calendar_sql()}
    SELECT o_orderkey, period FROM orders JOIN cal ON cal.day = CAST(o_orderdate AS DATE)""",
)
def rows_by_period(spark, folder):
    found = orders(spark, folder)
    split = split_periods(found, ORDERS)
    parts = [
        period_rows(found, ORDERS, split, period).select("o_orderkey", F.lit(period).alias("period"))
        for period in PERIODS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "day_set_rows",
    f"""WITH {calendar_sql()}
    SELECT o_orderkey FROM orders
    WHERE CAST(o_orderdate AS DATE) IN (SELECT day FROM cal WHERE dayofweek(day) = 0)""",
)
def day_set_rows(spark, folder):
    """Orders placed on the Sundays of the calendar: a set of days that is no range."""
    found = orders(spark, folder)
    days = calendar(found, ORDERS).where(F.dayofweek("day") == 1)
    return rows_for_days(found, ORDERS, days).select("o_orderkey")


@query(
    "stream_batches",
    f"""WITH {calendar_sql()}
    SELECT batch_id, min(day) AS day_min, max(day) AS day_max, count(*) AS date_count
    FROM cal WHERE batch_id IS NOT NULL GROUP BY batch_id""",
)
def batches(spark, folder):
    return stream_batches(calendar(orders(spark, folder), ORDERS))


WINDOW_SQL = """SELECT count(*) AS rows, strftime(min(o_orderdate), '%Y-%m-%d') AS date_min,
        strftime(max(o_orderdate), '%Y-%m-%d') AS date_max"""


@query(
    "known_period",
    f"""WITH {calendar_sql()} {WINDOW_SQL} FROM orders
    WHERE CAST(o_orderdate AS DATE) <= (SELECT max(day) FROM cal WHERE period = 'validation')""",
)
def known_period(spark, folder):
    found = orders(spark, folder)
    until = split_periods(found, ORDERS).last("validation")
    return window_metadata(known_rows(found, ORDERS, until), ORDERS)


@query(
    "rolling_period",
    f"""WITH {calendar_sql()} {WINDOW_SQL} FROM orders
    WHERE CAST(o_orderdate AS DATE) <= (SELECT max(day) FROM cal WHERE period = 'validation')
        AND CAST(o_orderdate AS DATE) >=
            (SELECT max(day) - 89 FROM cal WHERE period = 'validation')""",
)
def rolling_period(spark, folder):
    params = replace(ORDERS, model=replace(ORDERS.model, rolling_train_period_days=90))
    found = orders(spark, folder)
    until = split_periods(found, params).last("validation")
    return window_metadata(rolling_rows(found, params, until), params)
