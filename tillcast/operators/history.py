"""Histories: appending, best flags, tails, latest state, operation records."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillcast.operators.diagnostics import daily_timeline
from tillcast.sources.tables import METRIC_COLUMNS, OPERATIONS, KeyedTable, records

TAIL_ROWS = 5


def lead_columns(frame: DataFrame, preferred: Sequence[str] = METRIC_COLUMNS) -> DataFrame:
    """Known columns first, whatever else there is after them."""
    extras = [c for c in frame.columns if c not in preferred]
    return frame.select(*[c for c in preferred if c in frame.columns], *extras)


def flag_best(rows: DataFrame, metric: str, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Mark the rows with the lowest metric of their append; ties all count."""
    lowest = F.min(metric).over(Window.partitionBy(*by))
    return rows.withColumn("is_best_in_update", F.col(metric) == lowest)


def append_metrics(history: DataFrame | None, rows: DataFrame, metric: str) -> DataFrame:
    """History and new rows under one another, absent columns null."""
    flagged = flag_best(rows, metric)
    if history is not None:
        flagged = history.unionByName(flagged, allowMissingColumns=True)
    return lead_columns(flagged)


def tail(
    history: DataFrame, order: Sequence[str], columns: Sequence[str], rows: int = TAIL_ROWS
) -> DataFrame:
    """The last rows by an explicit order, present columns only, oldest first."""
    shown = [c for c in columns if c in history.columns]
    last = history.orderBy(*[F.col(c).desc() for c in order]).limit(rows)
    return last.orderBy(*order).select(*shown)


def latest(history: DataFrame, order: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """The named fields of the last row, one row even if the history is empty."""
    at = F.struct(*order)
    return history.agg(*[F.max_by(source, at).alias(name) for name, source in columns.items()])


def overview(
    project: str,
    selected_model: str,
    batches: DataFrame,
    quality: DataFrame,
    metrics: DataFrame,
    operations: DataFrame,
    operations_order: Sequence[str] = ("timestamp",),
) -> DataFrame:
    """The latest state of the four histories in one row."""
    parts = [
        latest(batches, ["batch_id"], {"latest_batch": "batch_id", "rows": "rows"}),
        latest(
            quality,
            ["batch_id"],
            {k: k for k in ("missing_part", "duplicate_part", "numeric_outlier_part")},
        ),
        latest(
            metrics,
            ["batch_id", "model_name"],
            {"model": "model_name", "rmse": "rmse", "mae": "mae", "r2": "r2"},
        ),
        latest(
            operations,
            operations_order,
            {"latest_operation": "operation", "latest_status": "status"},
        ),
    ]
    first, *others = parts
    states = [part.select(F.struct("*")).scalar().alias(f"s{i}") for i, part in enumerate(others)]
    fields = [F.col(c) for c in first.columns]
    fields += [F.col(f"s{i}.{c}") for i, part in enumerate(others) for c in part.columns]
    return (
        first.select("*", *states)
        .select(F.lit(project).alias("project"), *fields)
        .withColumn("model", F.coalesce("model", F.lit(selected_model)))
    )


def update_timeline(metrics: DataFrame, predictions: DataFrame) -> DataFrame:
    """Daily totals over the predictions of every stream update in the metric history."""
    keys = ["batch_id", "model_name"]
    updates = metrics.where(F.col("period_type") == "stream").select(*keys).distinct()
    return daily_timeline(predictions.join(updates, keys, "left_semi"))


class Operations:
    """Records each operation with its outcome, also when it fails.

    Records are only added, by operation and day, so the table has a folder per day, not per attempt.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def append(self, rows: Sequence[Mapping[str, object]]) -> None:
        """Add records; a field that isn't given is null."""
        if not rows:
            return
        values = [tuple(row.get(f.name) for f in OPERATIONS.fields) for row in rows]
        made = records(self.spark, values, OPERATIONS).withColumn("day", F.to_date("timestamp"))
        made.write.mode("append").partitionBy("operation", "day").parquet(self.path)

    @contextmanager
    def record(self, operation: str, run_id: str | None = None, **known):
        """Yields a dict for the fields that become known on the way."""
        fields = dict(known)
        started = time.perf_counter()
        status, error = "failure", None
        try:
            yield fields
            status = "success"
        except Exception as problem:
            error = str(problem)
            raise
        finally:
            if status == "failure":
                fields["output_rows"] = None
            attempt = uuid.uuid4().hex
            row = {
                **fields,
                # Every attempt has a record of its own, so a retry doesn't hide a failure.
                "run_id": f"{run_id}-{attempt}" if run_id else attempt,
                "timestamp": datetime.now(timezone.utc),
                "operation": operation,
                "status": status,
                "duration_seconds": time.perf_counter() - started,
                "error_message": error,
            }
            self.append([row])

    def read(self) -> DataFrame:
        return KeyedTable(self.spark, self.path).read(OPERATIONS)
