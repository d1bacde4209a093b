import pytest

from tillcast.operators.lookup import enrich, salted_lookup_join, unmatched_rows
from tillcast.params import DimensionParams

STORES = DimensionParams()


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([(1, 1.0), (2, 2.0), (1, 3.0)], "Store int, Sales double")


def stores(spark, rows):
    return spark.createDataFrame(rows, "Store int, StoreType string")


def test_join(spark, facts):
    made = enrich(facts, stores(spark, [(1, "a"), (2, "b"), (3, "c")]), STORES)
    assert sorted((r["Sales"], r["StoreType"]) for r in made.collect()) == [
        (1.0, "a"),
        (2.0, "b"),
        (3.0, "a"),
    ]


def test_repeated_key_fails(spark, facts):
    with pytest.raises(ValueError, match="not unique"):
        enrich(facts, stores(spark, [(1, "a"), (1, "b"), (2, "b")]), STORES)


@pytest.mark.parametrize("rows", [[(1, "a")], [(1, "a"), (2, None)]])
def test_fact_without_store_fails(spark, facts, rows):
    dimension = stores(spark, rows)
    with pytest.raises(Exception, match="no StoreType for Store 2"):
        enrich(facts, dimension, STORES).collect()
    assert unmatched_rows(facts, dimension, STORES) == 1


def test_skipped(spark, facts):
    assert enrich(facts, None, STORES) is facts
    keyless = facts.drop("Store")
    assert enrich(keyless, stores(spark, [(1, "a")]), STORES) is keyless
    done = stores(spark, [(1, "a")])
    assert enrich(done, done, STORES) is done
    with pytest.raises(ValueError):
        enrich(facts, done.withColumnRenamed("Store", "shop"), STORES)


def test_salted_join_of_a_hot_key(spark):
    """A third of the rows share a key, another part has none; nothing is lost or doubled."""
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, i) for i in range(3000)]
    facts = spark.createDataFrame(rows, "k long, v long")
    lookup = spark.range(3000).selectExpr("id as k", "id * 2 as w")
    made = salted_lookup_join(facts, lookup, "k", hot_share=0.01, salts=8).collect()
    assert sorted(r["v"] for r in made) == list(range(3000))
    assert all(r["w"] == (None if r["k"] is None else 2 * r["k"]) for r in made)


def test_large_dimension_takes_the_salted_path(spark, facts):
    dimension = stores(spark, [(1, "a"), (2, "b")])
    made = enrich(facts, dimension, STORES, broadcast_bytes=0)
    assert made.columns == ["Store", "Sales", "StoreType"] and made.count() == 3


def test_fact_without_store_fails_whichever_columns_are_read(spark, facts):
    made = enrich(facts, stores(spark, [(1, "a")]), STORES)
    with pytest.raises(Exception, match="no StoreType for Store 2"):
        made.agg({"Sales": "avg"}).collect()
    with pytest.raises(Exception, match="no StoreType for Store 2"):
        made.count()


def test_salted_join_of_rows_that_hold_a_map(spark):
    facts = spark.range(4).selectExpr("id % 2 as k", "struct(map('a', id) as m, array(id) as n) as s")
    lookup = spark.range(2).selectExpr("id as k", "id + 10 as w")
    made = salted_lookup_join(facts, lookup, "k", hot_share=0.01, salts=4).collect()
    assert sorted((r["s"]["m"]["a"], r["w"]) for r in made) == [(0, 10), (1, 11), (2, 10), (3, 11)]
