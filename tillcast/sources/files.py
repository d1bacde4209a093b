"""Scans of fact files, the store dimension and files to score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from tillcast.functions.columns import moment, quoted
from tillcast.params import SOURCE_FILE, DimensionParams, FileParams


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(files.exists(hadoop_path))


def read_file(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    files: FileParams = FileParams(),
) -> DataFrame:
    """One CSV or Parquet file or folder; a missing path is an error.

    CSV without a schema is read as text: the roles in the parameters give the types later,
    so no pass is spent on guessing them. Quotes in it are doubled, and texts that stand for a
    missing value become null.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no such source: {path}")
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.options(header=True, quote='"', escape='"', multiLine=files.multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    made = reader.csv(path)
    texts = [f.name for f in made.schema.fields if isinstance(f.dataType, StringType)]
    missing = {c: F.when(~quoted(c).isin(*files.null_texts), quoted(c)) for c in texts}
    return made.withColumns(missing) if missing else made


def with_times(
    frame: DataFrame, names: Sequence[str], formats: Sequence[str] = ()
) -> DataFrame:
    """Time columns of text in one of the formats as timestamps, where formats are given."""
    present = [n for n in names if formats and n in frame.columns]
    texts = [n for n in present if isinstance(frame.schema[n].dataType, StringType)]
    return frame.withColumns({n: moment(frame, n, formats) for n in texts}) if texts else frame


def tag_source(frame: DataFrame, keep_existing: bool = False) -> DataFrame:
    """Add the base name of the file each row came from."""
    if keep_existing and SOURCE_FILE in frame.columns:
        return frame
    return frame.withColumn(SOURCE_FILE, F.col("_metadata.file_name"))


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column one source lacks is null there."""
    if not frames:
        raise ValueError("no source files given")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def read_sources(
    spark: SparkSession,
    paths: Sequence[str],
    schema: StructType | str | None = None,
    columns: Mapping[str, Mapping[str, Column]] | None = None,
    files: FileParams = FileParams(),
) -> DataFrame:
    """Scan every fact file, tag its rows and put them under one another.

    ``columns`` may give, per path, the columns to take and how to name them.
    """
    frames = []
    for path in paths:
        frame = tag_source(read_file(spark, path, schema, files))
        if columns and path in columns:
            frame = frame.select(
                *[value.alias(name) for name, value in columns[path].items()], SOURCE_FILE
            )
        frames.append(frame)
    return union_sources(frames)


def locate_dimension(
    spark: SparkSession, dimension: DimensionParams, source_paths: Sequence[str] = ()
) -> str | None:
    """The given path, else the first that exists: external folder, then next to a source."""
    if dimension.path is not None:
        return dimension.path
    folders = [dimension.external_dir] if dimension.external_dir else []
    folders += [path.rstrip("/").rpartition("/")[0] or "." for path in source_paths]
    for folder in folders:
        candidate = f"{folder.rstrip('/')}/{dimension.file_name}"
        if path_exists(spark, candidate):
            return candidate
    return None


def read_dimension(
    spark: SparkSession,
    dimension: DimensionParams,
    source_paths: Sequence[str] = (),
    schema: StructType | str | None = None,
    files: FileParams = FileParams(),
) -> DataFrame | None:
    path = locate_dimension(spark, dimension, source_paths)
    if path is None:
        return None
    frame = read_file(spark, path, schema, files)
    if dimension.key not in frame.columns:
        raise ValueError(f"dimension key is missing: {path}: {dimension.key}")
    return frame
