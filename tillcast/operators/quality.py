"""Data-quality profile of a table or batch.

Column statistics share one aggregation; only duplicates, distinct counts and quartiles need
passes of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from tillcast.functions.columns import iso_day, moment, number, quoted, share
from tillcast.operators.quantiles import DIRECT_ROWS, Projection, exact_quantiles
from tillcast.params import JobParams
from tillcast.sources.tables import records

DISTINCT_COLUMNS_PER_PASS = 8


def _missing(frame: DataFrame) -> Column:
    cells = [quoted(c).isNull().cast("long") for c in frame.columns]
    return F.coalesce(F.sum(reduce(add, cells)), F.lit(0))


def missing_part(frame: DataFrame) -> DataFrame:
    width = len(frame.columns)
    return frame.agg(
        F.count(F.lit(1)).alias("rows"), _missing(frame).alias("missing_cells")
    ).withColumn("missing_part", share(F.col("missing_cells"), F.col("rows") * width))


def duplicate_rows(frame: DataFrame) -> DataFrame:
    """Rows that repeat an earlier one, nulls equal. Copies merge before the shuffle."""
    return (
        frame.groupBy(*map(quoted, frame.columns))
        .agg(F.count(F.lit(1)).alias("_copies"))
        .agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
        )
        .withColumn("duplicate_part", share(F.col("duplicate_rows"), F.col("rows")))
    )


def _is_constant(column: str) -> Column:
    """At most one distinct value, null counted as one: no distinct count needed."""
    value = quoted(column)
    all_null = F.count(value) == 0
    single = (F.count(value) == F.count(F.lit(1))) & (F.min(value) == F.max(value))
    return all_null | F.coalesce(single, F.lit(False))


def constant_columns(frame: DataFrame) -> DataFrame:
    """One row per constant column."""
    flags = F.array(*[F.when(_is_constant(c), F.lit(c)) for c in frame.columns])
    return frame.agg(F.array_compact(flags).alias("found")).select(
        F.explode("found").alias("column")
    )


def _distinct_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: a map of column to its number of different values, null left out."""
    parts = []
    for start in range(0, len(columns), DISTINCT_COLUMNS_PER_PASS):
        names = columns[start : start + DISTINCT_COLUMNS_PER_PASS]
        pairs = [x for c in names for x in (F.lit(c), F.count_distinct(quoted(c)))]
        parts.append(frame.agg(F.create_map(*pairs).alias("counts")))
    if not parts:
        return frame.sparkSession.range(1).select(
            F.lit(None).cast("map<string,bigint>").alias("counts")
        )
    whole = reduce(lambda a, b: a.unionByName(b), parts)
    if len(parts) == 1:
        return whole
    return whole.select(F.explode("counts")).agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("counts")
    )


def cardinality(frame: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Different non-null values per column that is present."""
    present = [c for c in columns if c in frame.columns]
    if approximate:
        pairs = [x for c in present for x in (F.lit(c), F.approx_count_distinct(quoted(c)))]
        counted = frame.agg(F.create_map(*pairs).alias("counts"))
    else:
        counted = _distinct_counts(frame, present)
    return counted.select(F.explode("counts").alias("column", "unique_values"))


SKETCHES = "column string, sketch binary, batch_id long"
#: Two to this many counters of a sketch: a standard error of 1.04 / 2 ** 6, 1.6 per cent, in 4 KB.
SKETCH_BITS = 12


def distinct_sketches(
    frame: DataFrame, columns: Sequence[str], by: Sequence[str] = (), bits: int = SKETCH_BITS
) -> DataFrame:
    """One sketch of the different non-null values per column that is present, and group.

    A sketch has a bounded size, and sketches of parts can be merged, so stored ones of every batch
    tell how many different values all batches have together, which no stored counts could.
    """
    present = [c for c in columns if c in frame.columns]
    if not present:
        return frame.select(*map(quoted, by)).limit(0).withColumns(
            {"column": F.lit(""), "sketch": F.lit(None).cast("binary")}
        )
    made = frame.groupBy(*map(quoted, by)).agg(
        *[F.hll_sketch_agg(quoted(c).cast("string"), bits).alias(f"_s{i}") for i, c in enumerate(present)]
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"_s{i}").alias("sketch"))
        for i, c in enumerate(present)
    ]
    return made.select(*map(quoted, by), F.inline(F.array(*rows)))


def merged_cardinality(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """About how many different values each column has over all its sketches, without the rows."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*map(quoted, by), "column").agg(merged.alias("unique_values"))


def outlier_columns(params: JobParams) -> list[str]:
    return list(dict.fromkeys([*params.roles.numeric, params.target_column]))


def outlier_rows(
    frame: DataFrame, columns: Sequence[str], direct_rows: int = DIRECT_ROWS
) -> DataFrame:
    """Values and interquartile outliers per column, as one row with a map.

    The quartiles are exact and reach the counting pass as two literals per column. All passes but the
    first read the stored numbers, not the frame.
    """
    present = {c: number(frame, c) for c in columns if c in frame.columns}
    empty = "map<string,struct<values:bigint,outliers:bigint>>"
    if not present:
        return frame.agg(F.lit(None).cast(empty).alias("found"))
    held = Projection.of(frame, present)
    quartiles = exact_quantiles(held, present, (0.25, 0.75), direct_rows)
    pairs: list[Column] = []
    for name, (_, found) in quartiles.items():
        value = held[name]
        if found is None or found[1] == found[0]:
            outside = F.lit(0).cast("long")
        else:
            reach = 1.5 * (found[1] - found[0])
            outside = F.count_if(
                (value < F.lit(found[0] - reach)) | (value > F.lit(found[1] + reach))
            )
        pairs += [F.lit(name), F.struct(F.count(value).alias("values"), outside.alias("outliers"))]
    made = F.create_map(*pairs)
    return held.rows.agg(made.cast(empty).alias("found"))


def iqr_outliers(
    frame: DataFrame, columns: Sequence[str], direct_rows: int = DIRECT_ROWS
) -> DataFrame:
    """One row per column, with the share over all columns beside it."""
    rows = outlier_rows(frame, columns, direct_rows).select(
        F.explode("found").alias("column", "f"), _overall("found").alias("numeric_outlier_part")
    )
    return rows.select(
        "column",
        F.col("f.values").alias("values"),
        F.col("f.outliers").alias("outliers"),
        share(F.col("f.outliers"), F.col("f.values")).alias("outlier_part"),
        "numeric_outlier_part",
    )


def _overall(found: str) -> Column:
    def total(field: str) -> Column:
        return F.aggregate(
            F.map_values(found), F.lit(0).cast("long"), lambda acc, x: acc + x[field]
        )

    return F.coalesce(share(total("outliers"), total("values")), F.lit(0.0))


def expected_columns(params: JobParams, serving: bool = False) -> list[str]:
    roles = params.roles
    tail = (*roles.ids, *roles.service) if serving else (*roles.service, params.target_column)
    return list(dict.fromkeys([*roles.numeric, *roles.categorical, *roles.datetime, *tail]))


def drift(columns: Sequence[str], params: JobParams, serving: bool = False):
    """Columns that are missing and columns that are new, in their order."""
    expected = expected_columns(params, serving)
    missing = [c for c in expected if c not in columns]
    extra = [c for c in columns if c not in expected]
    return missing, extra


def schema_drift(frame: DataFrame, params: JobParams, serving: bool = False) -> DataFrame:
    missing, extra = drift(frame.columns, params, serving)
    rows = [(c, "missing") for c in missing] + [(c, "extra") for c in extra]
    return records(frame.sparkSession, rows, "column string, kind string")


def column_profile(frame: DataFrame) -> DataFrame:
    """Type, null share and distinct count of every column, one row each."""
    names = frame.columns
    nulls = frame.agg(
        F.count(F.lit(1)).alias("rows"),
        F.create_map(
            *[x for c in names for x in (F.lit(c), F.count_if(quoted(c).isNull()))]
        ).alias("nulls"),
    ).select("rows", F.explode("nulls").alias("column", "missing"))
    kinds = F.create_map(*[F.lit(x) for c, kind in frame.dtypes for x in (c, kind)])
    distinct = _distinct_counts(frame, names).select(
        F.explode("counts").alias("column", "unique_values")
    )
    return nulls.join(F.broadcast(distinct), "column").select(
        "column",
        kinds[F.col("column")].alias("dtype"),
        share(F.col("missing"), F.col("rows")).alias("missing_part"),
        "unique_values",
    )


def quality_report(
    frame: DataFrame,
    params: JobParams,
    context: Mapping[str, Column] | None = None,
    serving: bool = False,
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """All quality metrics of a batch as one row; nested values stay arrays and maps."""
    names = frame.columns
    missing, extra = drift(names, params, serving)
    at = moment(frame, params.time_column) if params.time_column in names else F.lit(None)
    flags = F.array(*[F.when(_is_constant(c), F.lit(c)) for c in names])
    base = frame.agg(
        F.count(F.lit(1)).alias("rows"),
        _missing(frame).alias("missing_cells"),
        iso_day(F.min(at)).alias("date_min"),
        iso_day(F.max(at)).alias("date_max"),
        F.date_format(F.min(at), "yyyy-MM-dd HH:mm:ss").alias("time_min"),
        F.date_format(F.max(at), "yyyy-MM-dd HH:mm:ss").alias("time_max"),
        F.array_compact(flags).alias("constant_columns"),
    )
    present = [c for c in params.roles.categorical if c in names]
    copies = duplicate_rows(frame).select(F.struct("duplicate_rows", "duplicate_part"))
    report = base.select(
        "*",
        copies.scalar().alias("copies"),
        outlier_rows(frame, outlier_columns(params), direct_rows).scalar().alias("found"),
        _distinct_counts(frame, present).scalar().alias("counts"),
    )
    parts = F.transform_values("found", lambda _, f: share(f["outliers"], f["values"]))
    return report.select(
        *[value.alias(name) for name, value in (context or {}).items()],
        "rows",
        F.lit(len(names)).alias("columns"),
        "date_min",
        "date_max",
        "time_min",
        "time_max",
        share(F.col("missing_cells"), F.col("rows") * len(names)).alias("missing_part"),
        F.col("copies.duplicate_rows"),
        F.col("copies.duplicate_part"),
        "constant_columns",
        _strings(missing).alias("schema_missing_columns"),
        _strings(extra).alias("schema_extra_columns"),
        _overall("found").alias("numeric_outlier_part"),
        parts.alias("numeric_outlier_columns"),
        F.col("counts").alias("category_cardinality"),
    )


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def batch_metadata(
    frame: DataFrame,
    params: JobParams,
    by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Size, time range, null share and target statistics, per batch if ``by`` is given."""
    names = [c for c in (columns or frame.columns) if c not in by]
    at = moment(frame, params.time_column)
    target = number(frame, params.target_column)
    nulls = reduce(add, [quoted(c).isNull().cast("long") for c in names])
    rows = F.count(F.lit(1))
    indicator = params.indicator_column if params.target.add_indicator else ""
    return frame.groupBy(*by).agg(
        rows.alias("rows"),
        F.lit(len(names)).alias("columns"),
        F.lit(0).cast("long").alias("start_row"),
        rows.alias("end_row"),
        F.date_format(F.min(at), "yyyy-MM-dd HH:mm:ss").alias("time_min"),
        F.date_format(F.max(at), "yyyy-MM-dd HH:mm:ss").alias("time_max"),
        share(F.sum(nulls), rows * len(names)).alias("missing_part"),
        F.lit(sum(c in names for c in params.roles.numeric)).alias("numeric_features"),
        F.lit(sum(c in names for c in params.roles.categorical)).alias("categorical_features"),
        F.count_if(target.isNull()).alias("target_missing"),
        F.avg(target).alias("target_mean"),
        F.min(target).alias("target_min"),
        F.max(target).alias("target_max"),
        F.lit(params.target.missing_strategy).alias("target_missing_strategy"),
        F.lit(indicator).alias("target_missing_indicator_column"),
        iso_day(F.min(at)).alias("date_min"),
        iso_day(F.max(at)).alias("date_max"),
        F.count_distinct(F.to_date(at)).alias("date_count"),
    )


def source_profile(frame: DataFrame, params: JobParams) -> DataFrame:
    """What is known of a source before it is used."""
    names = frame.columns
    at = moment(frame, params.time_column) if params.time_column in names else F.lit(None)
    return frame.agg(
        F.count(F.lit(1)).alias("rows"),
        _missing(frame).alias("missing_cells"),
        iso_day(F.min(at)).alias("time_min"),
        iso_day(F.max(at)).alias("time_max"),
    ).select(
        "rows",
        F.lit(len(names)).alias("features"),
        F.lit(sum(c in names for c in params.roles.categorical)).alias("categorical_features"),
        F.lit(params.time_column in names).alias("has_time_column"),
        F.lit(params.target_column in names).alias("has_target_column"),
        share(F.col("missing_cells"), F.col("rows") * len(names)).alias("missing_part"),
        "time_min",
        "time_max",
    )
