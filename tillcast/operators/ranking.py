"""Global row positions without sorting a large table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillcast.session import settled_in_place

ONE_TASK_ROWS = 1_000_000
# monotonically_increasing_id keeps the row's place in its partition in the lower 33 bits.
PLACE_BITS = 33


def dense_index(
    frame: DataFrame,
    order: Sequence[Column | str],
    name: str,
    rows: int,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Add the 0-based position of each row in a total order.

    Up to a measured limit a plain window does. Beyond it the rows are range-partitioned and
    sorted, written to the checkpoint folder so that the partitions stay as they are, and each
    partition's rows are numbered from the count of rows before it.
    """
    if rows <= one_task_rows:
        return frame.withColumn(
            name, (F.row_number().over(Window.orderBy(*order)) - 1).cast("long")
        )
    ordered = settled_in_place(frame.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = ordered.withColumn("_at", F.monotonically_increasing_id())
    part = F.shiftright("_at", PLACE_BITS)
    # One row per partition, so the window below is small.
    starts = (
        placed.groupBy(part.alias("_part"))
        .count()
        .select(
            "_part",
            (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_start"),
        )
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
        .drop("_at", "_part", "_start")
    )


def row_order(at: Column, key: Column | None = None) -> Column:
    """Time, then key, packed into one number that hash aggregation can take the minimum of.

    ``key`` is a non-negative long; the result stands for the load order of the rows.
    """
    seconds = (
        F.datediff(F.to_date(at), F.lit("1970-01-01").cast("date")).cast("decimal(9,0)") * 86400
        + F.hour(at) * 3600
        + F.minute(at) * 60
        + F.extract(F.lit("SECONDS"), at)
    )
    micros = (seconds * 1_000_000).cast("decimal(19,0)")
    if key is None:
        return micros.cast("decimal(38,0)")
    room = F.lit("10000000000000000000").cast("decimal(20,0)")
    return (micros * room).cast("decimal(38,0)") + key.cast("decimal(19,0)")
