"""From raw documents to packed training sequences, stage by stage.

Every stage works on all that the one before has kept, is written as Parquet and read again. The
last one returns pieces with their ids; the others return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import curriculum, hosts, ledger, neardup, packing
from tillcast.llm.common import small_batches, table
from tillcast.session import settled, work_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail a base rule nor are rejected with their host."""
    small_batches(spark)
    judged, name = hosts.judge(docs)
    return judged.where(F.col(name)["kept"]).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, on five words from 80 per cent on."""
    small_batches(spark, 300)  # signatures take some hundred bytes a shingle, and workers hold a tokenizer
    return neardup.representatives(docs, neardup.NearDup(words=5, percent=80))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret masked."""
    path = work_path(spark, "ledger")
    ledger.scan(docs, path)
    return ledger.redact(docs, path)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, repeated and cut to meet the sources' targets."""
    return curriculum.mixed(docs)


def as_written(docs: DataFrame) -> DataFrame:
    """Rows in the order they were written in: by number of the file and place in it.

    Spark reads files by size. What isn't read from files directly keeps the order it has.
    """
    try:
        placed = docs.select("_metadata.file_name", "_metadata.row_index", F.struct("*").alias("row"))
    except AnalysisException:
        return docs
    number = F.regexp_extract("file_name", r"^part-(\d+)", 1).try_cast("long")
    return placed.orderBy(number, "file_name", "row_index").select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences whose lengths are powers of two, with their ids, numbered in training order."""
    small_batches(spark)
    method = packing.Packing(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(as_written(docs), method)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("secret scan", secrets),
    ("mixing", mixing),
    ("packing", packed),
]

#: SQL has no tokenizer; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
