"""Row cleaning: times, targets, types, leakage, order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillcast.functions.columns import moment, number, quoted, text
from tillcast.params import SOURCE_FILE, JobParams


def require_column(frame: DataFrame, name: str, what: str) -> None:
    if name not in frame.columns:
        raise ValueError(f"{what} column is missing: {name}")


def parse_time(frame: DataFrame, params: JobParams) -> DataFrame:
    """Parse the time column and drop the rows where that fails."""
    name = params.time_column
    require_column(frame, name, "time")
    return frame.withColumn(name, moment(frame, name, params.files.time_formats)).where(quoted(name).isNotNull())


def treat_target(frame: DataFrame, params: JobParams) -> DataFrame:
    """Make the target a number, mark and treat the rows that lack it."""
    name = params.target_column
    require_column(frame, name, "target")
    strategy = params.target.missing_strategy
    if strategy == "drop":
        # Says nothing new, but is a filter the scan can use.
        frame = frame.where(quoted(name).isNotNull())
    frame = frame.withColumn(name, number(frame, name))
    value = quoted(name)
    if params.target.add_indicator:
        frame = frame.withColumn(params.indicator_column, value.isNull().cast("int"))
    if strategy == "drop":
        return frame.where(value.isNotNull())
    if strategy == "keep":
        return frame
    fill = 0.0 if strategy == "fill_zero" else float(params.target.fill_value)
    return frame.withColumn(name, F.coalesce(value, F.lit(fill)))


def apply_types(frame: DataFrame, params: JobParams) -> DataFrame:
    """Numbers, strings and further times by column role; bad values become null."""
    roles = params.roles
    typed = {name: number(frame, name) for name in roles.numeric if name in frame.columns}
    for name in (*roles.categorical, *roles.ids, *roles.service):
        if name in frame.columns:
            typed[name] = text(name)
    for name in roles.datetime:
        if name in frame.columns and name != params.time_column:
            typed[name] = moment(frame, name, params.files.time_formats)
    return frame.withColumns(typed) if typed else frame


def drop_leakage(frame: DataFrame, params: JobParams) -> DataFrame:
    """Drop service columns, the source tag aside."""
    return frame.drop(*[name for name in params.roles.service if name != SOURCE_FILE])


def sort_rows(frame: DataFrame, params: JobParams) -> DataFrame:
    """Order by time, then source; for output that people read, training needs no order."""
    names = [n for n in (params.time_column, SOURCE_FILE) if n in frame.columns]
    return frame.orderBy(*map(quoted, names))


def clean_training(frame: DataFrame, params: JobParams) -> DataFrame:
    return (
        frame.transform(parse_time, params)
        .transform(treat_target, params)
        .transform(apply_types, params)
        .transform(drop_leakage, params)
    )


def clean_serving(frame: DataFrame, params: JobParams) -> DataFrame:
    return (
        frame.transform(parse_time, params)
        .transform(apply_types, params)
        .transform(drop_leakage, params)
    )
