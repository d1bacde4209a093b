"""Per-row diagnostics and the data behind each chart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillcast.functions.columns import clipped, close, finite, iso_day, not_below_zero, quoted
from tillcast.operators.quantiles import DIRECT_ROWS, exact_quantiles
from tillcast.operators.ranking import ONE_TASK_ROWS, dense_index
from tillcast.sources.tables import records

HISTOGRAM_BINS = 24
SAMPLE_ROWS = 1000
HISTORY_METRICS = ("rmse", "mae", "smape", "r2")


def residuals(frame: DataFrame, at: str, keep: Sequence[str] = ()) -> DataFrame:
    """Day, actual, clipped prediction, residual and the log1p pair of every row."""
    p = not_below_zero(F.col("prediction"))
    return frame.select(
        *map(quoted, keep),
        iso_day(quoted(at)).alias("date"),
        "actual",
        p.alias("prediction"),
        (F.col("actual") - p).alias("residual"),
        F.log1p(not_below_zero(F.col("actual"))).alias("actual_log1p"),
        F.log1p(p).alias("prediction_log1p"),
    )


def daily_timeline(frame: DataFrame, at: str = "date") -> DataFrame:
    """Sums of actual and prediction per day, with the offset from the first day."""
    complete = frame.select(
        F.to_date(quoted(at)).alias("date"), "actual", "prediction"
    ).dropna(subset=["date", "actual", "prediction"])
    daily = complete.groupBy("date").agg(
        F.sum("actual").alias("actual"), F.sum("prediction").alias("prediction")
    )
    # One row per day from here on.
    first = F.min("date").over(Window.partitionBy())
    return daily.withColumn("day_offset", F.datediff("date", first)).orderBy("date")


def padded_range(low: Column, high: Column) -> tuple[Column, Column]:
    flat = F.greatest(F.abs(low) * 0.1, F.lit(1.0))
    padding = F.when(close(low, high), flat).otherwise((high - low) * 0.05)
    return low - padding, high + padding


def robust_range(frame: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """The range a metric series is clipped to, for series of one row per batch."""
    v = F.when(finite(quoted(value)), quoted(value))
    found = frame.groupBy(*by).agg(
        F.count(v).alias("points"),
        F.min(v).alias("data_min"),
        F.max(v).alias("data_max"),
        F.percentile(v, F.array(F.lit(0.05), F.lit(0.95))).alias("q"),
    )
    low, high = F.col("q")[0], F.col("q")[1]
    padding = F.greatest(
        (high - low) * 0.15, F.abs(low) * 0.02, F.abs(high) * 0.02, F.lit(1e-6)
    )
    wide_low, wide_high = padded_range(F.col("data_min"), F.col("data_max"))
    found = found.withColumns(
        {
            "inner_low": F.greatest("data_min", low - padding),
            "inner_high": F.least("data_max", high + padding),
            "wide_low": wide_low,
            "wide_high": wide_high,
        }
    )
    use_wide = (
        (F.col("points") < 6)
        | close(low, high)
        | close(F.col("inner_low"), F.col("inner_high"))
    )

    def bound(side: str, empty: float) -> Column:
        chosen = F.when(use_wide, F.col(f"wide_{side}")).otherwise(F.col(f"inner_{side}"))
        return F.when(F.col("points") == 0, F.lit(empty)).otherwise(chosen)

    return found.select(
        *by, "points", bound("low", 0.0).alias("range_min"), bound("high", 1.0).alias("range_max")
    )


def metric_series(history: DataFrame, keys: Sequence[str] = ("batch_id",)) -> DataFrame:
    """One row per batch and metric, nulls dropped, values clipped to the metric's range."""
    present = [m for m in HISTORY_METRICS if m in history.columns]
    long = history.unpivot(
        [quoted(k) for k in keys], [quoted(m) for m in present], "metric", "value"
    ).where("value is not null")
    bounded = long.join(F.broadcast(robust_range(long, "value", ["metric"])), "metric")
    value = clipped(F.col("value"), F.col("range_min"), F.col("range_max"))
    return bounded.select(*keys, "metric", value.alias("value"), "range_min", "range_max")


def histogram(
    frame: DataFrame, value: str, bins: int = HISTOGRAM_BINS, direct_rows: int = DIRECT_ROWS
) -> DataFrame:
    """Equal bins between the 1 % and 99 % quantile, values beyond them in the end bins."""
    usable = frame.where(finite(quoted(value))).select(quoted(value).alias("v"))
    count, found = exact_quantiles(usable, {"v": F.col("v")}, (0.01, 0.99), direct_rows)["v"]
    if not count:
        schema = "bin int, bin_low double, bin_high double, rows long"
        return records(frame.sparkSession, [], schema)
    low, high = found
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    held = F.least(F.greatest(F.col("v"), F.lit(found[0])), F.lit(found[1]))
    place = F.floor((held - F.lit(low)) / F.lit(high - low) * bins)
    counts = usable.groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    every = frame.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("bin_high"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def scatter_sample(
    frame: DataFrame,
    x: str,
    y: str,
    order: Sequence[str],
    size: int = SAMPLE_ROWS,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Evenly spaced rows of a total order, at most ``size``; all rows if there are fewer."""
    usable = frame.where(finite(quoted(x)) & finite(quoted(y)))
    rows = usable.count()
    placed = dense_index(usable, [quoted(c) for c in order], "position", rows, one_task_rows)
    if rows <= size:
        return placed
    step = (rows - 1) / (size - 1)
    wanted = frame.sparkSession.range(size).select(
        F.when(F.col("id") == size - 1, F.lit(rows - 1).cast("long"))
        .otherwise(F.floor(F.col("id") * F.lit(step)))
        .cast("long")
        .alias("position")
    )
    return placed.join(F.broadcast(wanted), "position", "left_semi")
