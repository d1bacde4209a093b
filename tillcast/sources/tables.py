"""History tables whose writes replace the rows of their own batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.types import StructType

from tillcast.sources.files import path_exists


class KeyedTable:
    """A Parquet table partitioned by its key.

    Writing rows replaces exactly the partitions those rows name, so a retried batch leaves
    the table as one successful run would.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str] = ("batch_id",)):
        self.spark = spark
        self.path = path
        self.key = tuple(key)

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def write(self, rows: DataFrame) -> None:
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.key)
            .parquet(self.path)
        )

    def part(self, value: object) -> DataFrame:
        """The rows of one value of the first key column, without looking at other parts."""
        return self.spark.read.parquet(f"{self.path}/{self.key[0]}={value}")

    def read(self, schema: StructType | str | None = None) -> DataFrame:
        """The rows; an absent table is an empty frame of the given schema.

        Without a schema those of all files are merged, which is meant for small histories.
        """
        if not self.exists():
            if schema is None:
                raise FileNotFoundError(f"no such table: {self.path}")
            return records(self.spark, [], schema)
        if schema is not None:
            return self.spark.read.schema(schema).parquet(self.path)
        return self.spark.read.option("mergeSchema", True).parquet(self.path)


_KINDS = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "numbers": T.MapType(T.StringType(), T.DoubleType()),
}


def schema(**fields: str) -> StructType:
    """A schema of nullable fields, made without a session."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in fields.items()])


def records(spark: SparkSession, rows: Sequence[Sequence], of: StructType | str) -> DataFrame:
    """A handful of rows made on the driver, as literals: no Python worker takes part."""
    kinds = T.StructType.fromDDL(of) if isinstance(of, str) else of
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kinds])
    made = [
        F.struct(*[_literal(v).cast(f.dataType).alias(f.name) for v, f in zip(row, kinds)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*made)))


def _literal(value: object) -> Column:
    if isinstance(value, dict):
        pairs = [F.lit(x) for pair in value.items() for x in pair]
        return F.create_map(*pairs) if pairs else F.lit(None)
    return F.lit(value)


BATCH_METADATA = schema(
    batch_id="long",
    period_type="string",
    rows="long",
    columns="int",
    start_row="long",
    end_row="long",
    time_min="string",
    time_max="string",
    missing_part="double",
    numeric_features="int",
    categorical_features="int",
    target_missing="long",
    target_mean="double",
    target_min="double",
    target_max="double",
    target_missing_strategy="string",
    target_missing_indicator_column="string",
    date_min="string",
    date_max="string",
    date_count="long",
    initial_date_min="string",
    initial_date_max="string",
    initial_date_count="long",
    validation_date_min="string",
    validation_date_max="string",
    validation_date_count="long",
    stream_date_min="string",
    stream_date_max="string",
    stream_date_count="long",
)

OPERATIONS = schema(
    run_id="string",
    timestamp="timestamp",
    operation="string",
    status="string",
    duration_seconds="double",
    input_rows="long",
    output_rows="long",
    model_name="string",
    model_path="string",
    input_path="string",
    output_path="string",
    artifact_path="string",
    error_message="string",
)

# The columns a metric history leads with, in this order.
METRIC_COLUMNS = (
    "model_name", "batch_id", "period_type", "date_min", "date_max", "date_count",
    "rmse", "mae", "r2", "smape", "pearson_corr", "pearson_p_value",
    "prediction_mean", "target_mean", "train_rows", "valid_rows", "is_best_in_update",
    "training_mode", "update_strategy", "initial_training", "training_rows_total",
    "train_window_date_min", "train_window_date_max",
    "pretrain_rows", "pretrain_time_min", "pretrain_time_max",
    "prediction_model_path", "updated_model_path", "model_path",
)
