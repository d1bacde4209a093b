"""Splitting history by date: initial, validation and stream periods, stream batches.

Every date present belongs to one period and the periods follow one another, so rows are
picked by plain date comparisons that reach the scan. The calendar has one row per day; years
1 to 9999 hold at most 3.7 million days, which bounds its window and its broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillcast.functions.columns import day, iso_day, moment, quoted
from tillcast.operators.clean import require_column
from tillcast.params import JobParams

PERIODS = ("initial", "validation", "stream")


def distinct_days(frame: DataFrame, params: JobParams) -> DataFrame:
    require_column(frame, params.time_column, "time")
    found = frame.select(day(frame, params.time_column).alias("day"))
    return found.where("day is not null").distinct()


def calendar(frame: DataFrame, params: JobParams) -> DataFrame:
    """One row per present day: ordinal, period and, in the stream period, batch number."""
    model = params.model
    in_order = Window.orderBy("day")
    numbered = distinct_days(frame, params).select(
        "day",
        (F.row_number().over(in_order) - 1).cast("long").alias("ord"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("n"),
    )
    initial = F.greatest(
        F.floor(F.col("n") * F.lit(float(model.initial_train_ratio))), F.lit(1)
    ).cast("long")
    wanted = F.greatest(
        F.floor(F.col("n") * F.lit(float(model.validation_ratio))), F.lit(1)
    ).cast("long")
    sized = numbered.withColumn("initial_n", initial).withColumn(
        "validation_n",
        F.when(
            F.col("initial_n") + wanted >= F.col("n"),
            F.greatest(F.col("n") - F.col("initial_n") - 1, F.lit(1)),
        ).otherwise(wanted),
    )
    start = F.col("initial_n") + F.col("validation_n")
    return sized.select(
        "day",
        "ord",
        F.when(F.col("ord") < F.col("initial_n"), "initial")
        .when(F.col("ord") < start, "validation")
        .otherwise("stream")
        .alias("period"),
        F.when(
            F.col("ord") >= start,
            F.floor((F.col("ord") - start) / F.lit(model.stream_batch_days)).cast("long"),
        ).alias("batch_id"),
    )


def boundaries(days: DataFrame) -> DataFrame:
    """First day, last day and day count of each period, as one wide row; empty is ''."""

    def fields(period: str) -> list[Column]:
        inside = F.when(F.col("period") == period, F.col("day"))
        return [
            F.coalesce(iso_day(F.min(inside)), F.lit("")).alias(f"{period}_date_min"),
            F.coalesce(iso_day(F.max(inside)), F.lit("")).alias(f"{period}_date_max"),
            F.count(inside).alias(f"{period}_date_count"),
        ]

    return days.agg(*[field for period in PERIODS for field in fields(period)])


@dataclass(frozen=True)
class Split:
    """The split as nine values on the driver; the fields of :func:`boundaries`."""

    fields: dict[str, str | int]

    def first(self, period: str) -> date | None:
        return _parsed(self.fields[f"{period}_date_min"])

    def last(self, period: str) -> date | None:
        return _parsed(self.fields[f"{period}_date_max"])

    def days(self, period: str) -> int:
        return int(self.fields[f"{period}_date_count"])


def split_periods(frame: DataFrame, params: JobParams, days: DataFrame | None = None) -> Split:
    found = boundaries(calendar(frame, params) if days is None else days).first().asDict()
    total = sum(found[f"{period}_date_count"] for period in PERIODS)
    if total == 0:
        raise ValueError(f"no valid dates in column: {params.time_column}")
    if total < 3:
        raise ValueError("a period split needs at least three different dates")
    return Split(found)


def stream_batches(days: DataFrame) -> DataFrame:
    """One row per stream batch with its day range."""
    return (
        days.where("batch_id is not null")
        .groupBy("batch_id")
        .agg(
            F.min("day").alias("day_min"),
            F.max("day").alias("day_max"),
            F.count("day").alias("date_count"),
        )
    )


def rows_between(
    frame: DataFrame, params: JobParams, first: date | None, last: date | None
) -> DataFrame:
    """Rows whose day lies in a closed range, compared on the time column itself."""
    if first is None or last is None:
        return frame.where(F.lit(False))
    at = moment(frame, params.time_column)
    return frame.where(
        (at >= F.lit(first).cast("timestamp_ntz"))
        & (at < F.date_add(F.lit(last), 1).cast("timestamp_ntz"))
    )


def period_rows(frame: DataFrame, params: JobParams, split: Split, period: str) -> DataFrame:
    return rows_between(frame, params, split.first(period), split.last(period))


def rows_for_days(frame: DataFrame, params: JobParams, days: DataFrame) -> DataFrame:
    """Rows whose day is in a set of days, for sets that are no range."""
    return (
        frame.withColumn("_day", day(frame, params.time_column))
        .join(F.broadcast(days.select(F.col("day").alias("_day")).distinct()), "_day", "left_semi")
        .drop("_day")
    )


def without_days(frame: DataFrame, params: JobParams, days: DataFrame) -> DataFrame:
    """Rows whose day isn't in a set of days; rows without a day stay."""
    return (
        frame.withColumn("_day", day(frame, params.time_column))
        .join(F.broadcast(days.select(F.col("day").alias("_day")).distinct()), "_day", "left_anti")
        .drop("_day")
    )


def known_rows(frame: DataFrame, params: JobParams, until: date) -> DataFrame:
    """Rows up to and including a day."""
    at = moment(frame, params.time_column)
    return frame.where(at < F.date_add(F.lit(until), 1).cast("timestamp_ntz"))


def rolling_rows(frame: DataFrame, params: JobParams, until: date) -> DataFrame:
    """Rows of the last N days up to and including a day."""
    back = params.model.rolling_train_period_days - 1
    at = moment(frame, params.time_column)
    return known_rows(frame, params, until).where(
        at >= F.date_sub(F.lit(until), back).cast("timestamp_ntz")
    )


def window_metadata(frame: DataFrame, params: JobParams) -> DataFrame:
    at = quoted(params.time_column)
    return frame.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(iso_day(F.min(at)), F.lit("")).alias("date_min"),
        F.coalesce(iso_day(F.max(at)), F.lit("")).alias("date_max"),
    )


def _parsed(value: str | int) -> date | None:
    return date.fromisoformat(str(value)) if value else None
