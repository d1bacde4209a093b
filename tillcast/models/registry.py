"""Model versions, the current one and the best one.

One row per batch; registering a batch again replaces its row. Pretraining is batch -1.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F

from tillcast.models.factory import signature
from tillcast.operators.features import PREPROCESSING_VERSION
from tillcast.params import ModelParams, canonical_model_name
from tillcast.sources.tables import KeyedTable, records, schema

PRETRAIN_BATCH = -1
VERSIONS = schema(
    batch_id="long",
    model_name="string",
    preprocessing_version="string",
    signature="string",
    model_path="string",
    metrics="numbers",
    registered_at="timestamp",
)


def champions(versions: DataFrame, metric: str) -> DataFrame:
    """The best version as of each version.

    A version takes over if its preprocessing or signature differs from the best one's, or
    if it is strictly better. So the best one is the earliest minimum since the signature last
    changed. There is one row per batch, which keeps the window small.
    """
    in_order = Window.orderBy("batch_id")
    kind = F.struct("preprocessing_version", "signature")
    changed = F.coalesce((F.lag(kind).over(in_order) != kind).cast("int"), F.lit(0))
    runs = versions.withColumn("_changed", changed).withColumn(
        "_run", F.sum("_changed").over(in_order)
    )
    so_far = (
        Window.partitionBy("_run")
        .orderBy("batch_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    score = F.col("metrics")[metric] if "metrics" in versions.columns else F.col(metric)
    # A version without a score gives way to any later one.
    at = F.when(score.isNull(), -F.col("batch_id")).otherwise(F.col("batch_id"))
    earliest = F.struct(score.isNull().alias("missing"), score.alias("score"), at.alias("at"))
    return runs.withColumn(
        "best_batch_id", F.min_by("batch_id", earliest).over(so_far)
    ).drop("_changed", "_run")


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str, params: ModelParams):
        self.spark = spark
        self.root = root.rstrip("/")
        self.params = params
        self.table = KeyedTable(spark, f"{self.root}/versions")

    def versions(self) -> DataFrame:
        return self.table.read(VERSIONS)

    def register(
        self,
        model: PipelineModel,
        batch_id: int,
        model_name: str,
        metrics: Mapping[str, object],
    ) -> str:
        """Save a version; it becomes the current one, and the best one if it earns that."""
        name = canonical_model_name(model_name)
        path = f"{self.root}/archive/{batch_id}/{name}"
        model.write().overwrite().save(path)
        numbers = {
            k: float(v)
            for k, v in metrics.items()
            if isinstance(v, (int, float)) and not isinstance(v, bool)
        }
        row = (
            batch_id,
            name,
            PREPROCESSING_VERSION,
            signature(self.params, name),
            path,
            numbers,
            datetime.now(timezone.utc),
        )
        self.table.write(records(self.spark, [row], VERSIONS))
        return path

    def current(self) -> Row | None:
        return self.versions().orderBy(F.desc("batch_id")).limit(1).first()

    def best(self) -> Row | None:
        versions = self.versions()
        ranked = champions(versions, self.params.primary_metric)
        last = ranked.orderBy(F.desc("batch_id")).limit(1).first()
        if last is None:
            return None
        return versions.where(F.col("batch_id") == last["best_batch_id"]).first()

    def mismatch(self, version: Row) -> str | None:
        """Why a version does not fit the parameters, or nothing."""
        if version["model_name"] != self.params.selected:
            return f"model is {version['model_name']}, expected {self.params.selected}"
        if version["preprocessing_version"] != PREPROCESSING_VERSION:
            return f"preprocessing is {version['preprocessing_version']}"
        if version["signature"] != signature(self.params, self.params.selected):
            return "hyperparameters differ"
        return None

    def load(self, version: Row | None, what: str) -> PipelineModel:
        if version is None:
            raise FileNotFoundError(f"no {what} model; train one first")
        problem = self.mismatch(version)
        if problem:
            raise ValueError(f"{what} model does not fit: {problem}; train again")
        return PipelineModel.load(version["model_path"])

    def load_current(self) -> PipelineModel:
        return self.load(self.current(), "current")
