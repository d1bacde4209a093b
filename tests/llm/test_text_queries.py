"""Each query on text against its SQL twin on the smallest data; the pipeline's stages one by one."""

import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tillcast.llm import neardup
from tillcast.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    frame = QUERIES[name](spark, DATA)
    columns = sorted(frame.columns)
    relation = database.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    places = [relation.columns.index(c) for c in columns]
    found = sorted(tuple(map(str, r)) for r in frame.select(*columns).collect())
    assert found == sorted(tuple(str(row[i]) for i in places) for row in relation.fetchall())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA).persist()
        assert docs.columns == columns
        kept[name] = docs.collect()
        assert kept[name]
    good, single, clean, mixed = kept.values()
    assert all(len(r.text.split()) >= 10 for r in good)
    assert len({r.doc_id for r in single}) == len(single) <= len(good)
    groups = neardup.groups(spark.createDataFrame(good), neardup.NearDup()).collect()
    assert {r.doc_id for r in single} == {r.component_id for r in groups}
    assert {r.doc_id for r in clean} == {r.doc_id for r in single}
    by_id = {r.doc_id: r.text for r in clean}
    assert all(by_id[r.doc_id].startswith(r.text) for r in mixed)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    expected = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed)
    assert sum(p.length for p in pieces) == expected
    assert all(zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 for p in pieces[:200])


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    assert docs.collect() == []
