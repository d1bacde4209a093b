"""Column expressions: safe parsing, clipping, safe division, calendar parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

CLOSE_ABSOLUTE = 1e-8
CLOSE_RELATIVE = 1e-5


def quoted(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def number(frame: DataFrame, name: str) -> Column:
    """The column as a double; whatever is no number becomes null."""
    kind = frame.schema[name].dataType
    raw = quoted(name)
    if isinstance(kind, T.StringType):
        # A trailing d or f is a Java type suffix, not part of a number.
        raw = F.when(~F.trim(raw).rlike("[0-9.][dDfF]$"), raw)
        value = raw.try_cast("double")
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        value = raw.cast("double")
    elif isinstance(kind, (T.NumericType, T.BooleanType)):
        return raw.cast("double")
    else:
        value = raw.cast("string").try_cast("double")
    return F.when(~F.isnan(value), value)


def moment(frame: DataFrame, name: str, formats: Sequence[str] = ()) -> Column:
    """The column as a timestamp without zone; whatever does not parse becomes null.

    Texts are tried as ISO times first, then in each of the formats.
    """
    kind = frame.schema[name].dataType
    raw = quoted(name)
    if isinstance(kind, T.TimestampNTZType):
        return raw
    if isinstance(kind, T.StringType):
        tried = [F.try_to_timestamp(raw, F.lit(f)).cast("timestamp_ntz") for f in formats]
        return F.coalesce(raw.try_cast("timestamp_ntz"), *tried)
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return raw.try_cast("timestamp_ntz")
    return raw.cast("string").try_cast("timestamp_ntz")


def day(frame: DataFrame, name: str) -> Column:
    return F.to_date(moment(frame, name))


def text(name: str) -> Column:
    return quoted(name).cast("string")


def iso_day(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def not_below_zero(value: Column) -> Column:
    """Clip at zero, null stays null."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def clipped(value: Column, low: Column, high: Column) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def share(part: Column, whole: Column) -> Column:
    """part / whole, zero when the whole is not positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def close(left: Column, right: Column) -> Column:
    """Equal within the usual float tolerance."""
    return F.abs(left - right) <= F.lit(CLOSE_ABSOLUTE) + F.lit(CLOSE_RELATIVE) * F.abs(right)


def sorted_json(mapping: Column) -> Column:
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(mapping))))


def calendar_parts(at: Column, prefix: str) -> list[Column]:
    """Year, month, quarter, day and ISO week of a time, as doubles."""
    parts = {
        "year": F.year(at),
        "month": F.month(at),
        "quarter": F.quarter(at),
        "day": F.dayofmonth(at),
        "weekofyear": F.weekofyear(at),
    }
    return [part.cast("double").alias(f"{prefix}_{name}") for name, part in parts.items()]
