"""What several of the operators on text share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: A table is broadcast only if it was counted and this many bytes hold it.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send at most so many rows to Python at once, as a text may be very long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def unused(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column is called so in either case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str = "text") -> Column:
    """The text as a string, empty if null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def small_enough(frame: DataFrame, row_bytes: int) -> DataFrame:
    """Mark a stored table for broadcast if its counted rows surely fit; else leave it as it is."""
    fits = frame.count() * row_bytes <= BROADCAST_BYTES
    return F.broadcast(frame) if fits else frame


def hex_of(column: Column) -> Column:
    """Lowercase SHA-256 of a string's UTF-8 bytes."""
    return F.sha2(column.cast("binary"), 256)
