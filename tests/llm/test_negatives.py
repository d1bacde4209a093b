"""Hard negatives against all pairs in whole numbers; Strassen's recursion against plain products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm import negatives

VECTORS = "vec_id long, embedding array<float>, label int, id string, Score double"


def plain(rows, method=negatives.Mining(), every=100):
    """(anchor, positive, rank, negative, scores) of rows (id, vector, label)."""
    usable = [
        (i, [math.floor(method.scale * float(np.float32(x))) for x in v], l)
        for i, v, l in rows
        if i is not None and l is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    usable = sorted(set((i, tuple(v), l) for i, v, l in usable))
    found = set()
    for i, v, l in usable:
        if i % every:
            continue
        scores = sorted({(-sum(x * y for x, y in zip(v, w)), j, m) for j, w, m in usable if j != i})
        positives = [(-s, j) for s, j, m in scores if m == l][: method.positives]
        for p, j in positives:
            low, high = method.low * p, method.high * p
            inside = [(-s, n) for s, n, m in scores if m != l and low <= -100 * s <= high]
            for rank, (s, n) in enumerate(inside[: method.negatives], 1):
                found.add((i, j, rank, n, p, s))
    return found


def mined(spark, rows, method=negatives.Mining(), every=100):
    given = spark.createDataFrame([(i, v, l, "x", 1.0) for i, v, l in rows], VECTORS)
    made = negatives.hard_negatives(given, F.col("id") % every == 0, method)
    return [tuple(r) for r in made.collect()]


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 5, 3), (33, 64, 65), (100, 37, 259), (0, 4, 9), (3, 0, 2)])
def test_products(shape):
    p, d, q = shape
    r = np.random.default_rng(p)
    a, b = r.integers(-(2**20), 2**20, (p, d)), r.integers(-(2**20), 2**20, (d, q))
    for leaf in (1, 2, 16):
        np.testing.assert_array_equal(negatives.multiplied(a, b, leaf), a @ b)


def test_products_wrap_to_the_exact_score():
    a = np.array([[2**40, 2**40], [3, 1]])
    b = np.array([[2**40, 5], [-(2**40), 7]])
    exact = a.astype(object) @ b.astype(object)
    np.testing.assert_array_equal(negatives.multiplied(a, b, 1).astype(object), exact)


def test_window_in_whole_numbers():
    method = negatives.Mining()
    for score in [0, 1, 7, 99, 100, 10**18 + 7, -5]:
        low, high = negatives.window(score, method)
        assert 100 * low >= 30 * score > 100 * (low - 1)
        assert 100 * high <= 90 * score < 100 * (high + 1)
    assert negatives.window(-100, method) == (-30, -90)


def test_equals_all_pairs(spark):
    r = random.Random(3)
    centres = [[r.gauss(0, 0.4) for _ in range(12)] for _ in range(3)]
    rows = []
    for i in range(360):
        label = r.choice([0, 0, 0, 1, 2])
        rows.append((i, [c + 0.5 + r.gauss(0, 0.2) for c in centres[label]], label))
    rows[50:90] = [(i, rows[50][1], i % 2) for i in range(50, 90)]  # ties
    rows += [
        rows[0], rows[17], (17, rows[18][1], 1), (400, None, 1), (500, rows[0][1], None),
        (None, rows[0][1], 0), (600, [1.0] * 11 + [None], 0), (700, [float("nan")] * 12, 0),
        (800, [float("inf")] + [0.0] * 11, 0), (900, [], 0), (20, [1.0, 2.0], 0), (1000, [0.0] * 12, 7),
        (100000, [3.0] * 40, 1),
    ]
    expected = plain(rows, every=20)
    assert len(expected) > 300
    for method in (negatives.Mining(), negatives.Mining(tile=50, rows_at_once=2, leaf=2)):
        found = mined(spark, rows, method, every=20)
        assert len(found) == len(set(found)) and set(found) == expected


def test_negative_scores_and_few_rows(spark):
    rows = [(0, [1.0], 0), (1, [-1.0], 0), (2, [-0.5], 1), (3, [0.5], 1)]
    assert mined(spark, rows) == [] == sorted(plain(rows))
    rows = [(0, [1.0], 0), (1, [1.0], 0), (2, [0.5], 1), (3, [0.2], 1), (4, [0.95], 2)]
    assert set(mined(spark, rows)) == plain(rows) == {(0, 1, 1, 2, 65536, 32768)}
    assert mined(spark, []) == [] and mined(spark, rows[:1]) == []


def test_scores_that_may_not_fit_are_an_error(spark):
    rows = [(0, [1e12], 0), (1, [1.0], 0), (2, [1.0], 1)]
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, rows)
    assert mined(spark, [(0, [1.0] * 100_000, 0), (1, [1.0], 0), (2, [0.5], 1)])[0][4:] == (65536, 32768)
