"""The report over a workspace: everything a reader of the histories sees, as tables.

One call reads what pretraining, the stream and the scoring jobs have left and writes each part of the
report beside it. Only committed batches count. The parts over predictions are aggregates, a bounded
histogram and a bounded sample; those over histories have a row per batch at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillcast.operators.diagnostics import histogram, metric_series, scatter_sample
from tillcast.operators.history import overview, tail, update_timeline
from tillcast.operators.quality import SKETCHES, merged_cardinality
from tillcast.params import JobParams
from tillcast.plans.jobs import Workspace

# What the last rows of each history show.
METRIC_TAIL = ("batch_id", "model_name", "rmse", "mae", "r2", "smape", "is_best_in_update")
BATCH_TAIL = ("batch_id", "period_type", "rows", "date_min", "date_max", "target_mean", "missing_part")
QUALITY_TAIL = (
    "batch_id", "rows", "missing_part", "duplicate_part", "numeric_outlier_part", "schema_missing_columns",
)
OPERATION_TAIL = ("timestamp", "operation", "status", "duration_seconds", "input_rows", "error_message")
FIRST_FEATURES = 5
QUALITY = (
    "batch_id long, rows long, missing_part double, duplicate_part double, "
    "numeric_outlier_part double, schema_missing_columns array<string>"
)
PREDICTIONS = "date string, actual double, prediction double, residual double, batch_id long, model_name string"
IMPORTANCES = "feature string, value double, abs_value double, batch_id long, model_name string"


def report_parts(workspace: Workspace, params: JobParams) -> dict[str, DataFrame]:
    """Each part of the report by name, not run yet."""
    batches = workspace.committed()
    done = batches.select("batch_id")
    metrics = workspace.metrics.read().withColumn("batch_id", F.col("batch_id").cast("long"))
    known = metrics.where("batch_id < 0").unionByName(metrics.join(done, "batch_id", "left_semi"))
    quality = workspace.quality.read(QUALITY).join(done, "batch_id", "left_semi")
    operations = workspace.operations.read()
    scored = workspace.predictions.read(PREDICTIONS).join(done, "batch_id", "left_semi")
    features = workspace.importances.read(IMPORTANCES)
    last = features.join(
        features.agg(F.max(F.struct("batch_id", "model_name")).alias("last")),
        F.struct("batch_id", "model_name") == F.col("last"),
    ).drop("last")
    return {
        "overview": overview(
            params.project, params.model.selected, batches, quality, known, operations
        ),
        "metrics": tail(known, ["batch_id", "model_name"], METRIC_TAIL),
        "batches": tail(batches, ["batch_id"], BATCH_TAIL),
        "quality": tail(quality, ["batch_id"], QUALITY_TAIL),
        "operations": tail(operations, ["timestamp", "run_id"], OPERATION_TAIL),
        "timeline": update_timeline(known, scored),
        "series": metric_series(known, ["batch_id", "model_name"]),
        "residuals": histogram(scored, "residual"),
        "sample": scatter_sample(
            scored, "actual", "prediction", ["batch_id", "date", "actual", "prediction"]
        ),
        "features": last.orderBy(F.desc("abs_value"), "feature").limit(FIRST_FEATURES),
        "categories": merged_cardinality(
            workspace.sketches.read(SKETCHES).join(done, "batch_id", "left_semi")
        ),
    }


def write_report(workspace: Workspace, params: JobParams) -> dict[str, str]:
    """Write every part anew under ``report``; returns their paths."""
    paths = {}
    with workspace.operations.record("report", model_name=params.model.selected) as record:
        for name, part in report_parts(workspace, params).items():
            paths[name] = workspace.path(f"report/{name}")
            part.coalesce(1).write.mode("overwrite").parquet(paths[name])
        record["output_path"] = workspace.path("report")
    return paths


def read_report(workspace: Workspace, name: str) -> DataFrame:
    return workspace.spark.read.parquet(workspace.path(f"report/{name}"))
