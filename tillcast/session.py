"""Session helpers: where shared intermediate data goes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "tillcast") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="tillcast-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path for one run under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def settled(frame: DataFrame) -> DataFrame:
    """Write the frame once to the shared folder and read on from there."""
    path = work_path(frame.sparkSession, "settled")
    frame.write.parquet(path)
    made = frame.sparkSession.read.schema(frame.schema).parquet(path)
    made.settled_path = path
    return made


def released(*frames: DataFrame) -> None:
    """Give back the space of settled frames; nothing that is still to run may read them."""
    for frame in frames:
        none = frame.sparkSession.createDataFrame([], frame.schema)
        none.coalesce(1).write.mode("overwrite").parquet(frame.settled_path)


def settled_in_place(frame: DataFrame) -> DataFrame:
    """The same with every row staying in its partition and at its place there."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)
