"""Each query against its SQL twin on the smallest data."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tillcast.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
# The tables the SQL twins may name.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}
# These run for long and have tests of their own.
SLOW = {"multi_model", "best_timeline", "pretrain"}

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def in_order(rows):
    made = [tuple(map(plain, row)) for row in rows]
    return sorted(made, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(ORACLES.keys() - SLOW))
def test_query_equals_sql(spark, database, name):
    frame = QUERIES[name](spark, DATA)
    columns = sorted(frame.columns)
    found = in_order(frame.select(*[f"`{c}`" for c in columns]).collect())
    relation = database.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    places = [relation.columns.index(c) for c in columns]
    expected = in_order([[row[i] for i in places] for row in relation.fetchall()])
    assert found == expected
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: KINDS[kind] for c, kind in frame.dtypes} == kinds


def test_loaded_files_are_parsed_once(spark):
    """What is read from CSV is joined and read on from a table, not parsed for every job."""
    files = QUERIES["csv_round_trip"](spark, DATA).inputFiles()
    assert files and not [f for f in files if f.endswith(".csv")]


def test_entry(spark):
    assert contract.entry(spark).count() == 2
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize(
    "name", sorted(QUERIES.keys() - ORACLES.keys() - SLOW)
)
def test_query_has_rows(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
