"""Daily totals of the stream's predictions, kept by a streaming aggregation as the table grows.

The predictions of a batch are files, and a batch that is run again has new ones. So the state adds up
by day and by the write that made the files, which their names tell, and what was kept of a write counts
only while its files are the batch's own and the batch is committed: a retried batch is never in the
totals twice, and one that failed isn't in them at all. The state is checkpointed; a micro-batch
hands on the sums it changed, which replace those of earlier ones.

The state has one row per batch, write and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillcast.plans.jobs import Workspace
from tillcast.streaming.calendar import EPOCH

PREDICTIONS = "date string, actual double, prediction double, batch_id long, model_name string"
KEYS = ("batch_id", "model_name", "write_id")
TOTALS = (
    "batch_id long, model_name string, write_id string, date date, actual double, "
    f"prediction double, rows long, {EPOCH} long"
)


def write_id() -> Column:
    """The write that made a row's file: Spark names all files of one write alike."""
    return F.regexp_extract("_metadata.file_name", r"^part-\d+-([0-9a-f-]{36})", 1)


class DailyTotals:
    def __init__(self, workspace: Workspace):
        self.workspace = workspace
        self.table = workspace.table("daily_totals", EPOCH)

    def follow(self, **trigger) -> StreamingQuery:
        """A query that adds up predictions as they are written; a trigger as Spark names it."""
        spark = self.workspace.spark
        # A retry may take away files that were seen but not read yet.
        rows = (
            spark.readStream.schema(PREDICTIONS)
            .option("ignoreMissingFiles", True)
            .parquet(self.workspace.predictions.path)
        )
        complete = rows.select(
            "batch_id", "model_name", write_id().alias("write_id"),
            F.to_date("date").alias("date"), "actual", "prediction",
        ).dropna(subset=["date", "actual", "prediction"])
        sums = complete.where("batch_id >= 0").groupBy(*KEYS, "date").agg(
            F.sum("actual").alias("actual"),
            F.sum("prediction").alias("prediction"),
            F.count(F.lit(1)).alias("rows"),
        )

        def store(changed: DataFrame, epoch: int) -> None:
            self.table.write(changed.withColumn(EPOCH, F.lit(epoch).cast("long")).coalesce(1))

        return (
            sums.writeStream.outputMode("update")
            .option("checkpointLocation", self.workspace.path("daily_totals_checkpoint"))
            .trigger(**(trigger or {"availableNow": True}))
            .foreachBatch(store)
            .start()
        )

    def read(self) -> DataFrame:
        """(date, actual, prediction, rows, day_offset) over all committed batches so far."""
        space = self.workspace
        last = F.max_by(F.struct("actual", "prediction", "rows"), EPOCH).alias("sums")
        kept = self.table.read(TOTALS).groupBy(*KEYS, "date").agg(last)
        # Counts rows by file without reading a column.
        own = space.predictions.read(PREDICTIONS).select(*KEYS[:2], write_id().alias("write_id"))
        valid = own.distinct().join(space.committed().select("batch_id"), "batch_id", "left_semi")
        daily = (
            kept.join(valid, list(KEYS), "left_semi")
            .groupBy("date")
            .agg(*[F.sum(f"sums.{c}").alias(c) for c in ("actual", "prediction", "rows")])
        )
        # One row per day from here on.
        first = F.min("date").over(Window.partitionBy())
        return daily.withColumn("day_offset", F.datediff("date", first))
