"""SimHash groups against all pairs, fingerprints against one bit at a time, codes against their claims."""

import random
from math import comb

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillcast.llm import anchors
from tillcast.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(k, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, threshold=2):
    """From id to the smallest id reachable."""
    root = {id: id for id in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= threshold:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {id: find(id) for id in ids}


def unsigned(value):
    return value % 2**64


@pytest.mark.parametrize("code", [anchors.GOLAY, anchors.HAMMING])
def test_codes_are_perfect(code):
    keys = [key for w in range(code.radius + 1) for key, words in code.by_syndrome(w).items() for _ in words]
    assert sorted(keys) == list(range(1 << code.degree))
    assert sum(comb(code.length, w) for w in range(code.radius + 1)) == 1 << code.degree


@pytest.mark.parametrize("blocks", anchors.CODES)
def test_each_visits_the_other_s_home(blocks):
    r = random.Random(4)
    visits = anchors.Visits(blocks, 2)

    def at(value, excess):
        made = visits.anchors(np.array([value], np.uint64), excess)
        return [int(a) for _, found in made for a in found]

    for _ in range(60):
        x = r.getrandbits(64)
        y = x ^ sum(1 << b for b in r.sample(range(64), r.randrange(3)))
        home, seen = at(x, 0), at(y, 2)
        assert len(home) == 1 and len(seen) == len(set(seen)) and home[0] in seen
        assert set(at(y, 0)) <= set(seen)


def test_fingerprints_bit_by_bit(documents, monkeypatch):
    r = random.Random(2)
    words = ["Ä", "B", "c", "ΣΑ", "x" * 50, "1", "ß "]
    texts = [None, "", " \t\n", "Alone", "two Words", "a\x0bb\x0cc\rd", "a\x1cb c d"]
    texts += [" ".join(r.choices(words, k=n)) for n in (3, 4, 5, 100, 254, 257, 258, 2000)]
    given = list(enumerate(texts))
    expected = {i: plain_fingerprint(t) for i, t in given}
    for size in (anchors.SLICE, 64):
        monkeypatch.setattr(anchors, "SLICE", size)
        slices = {i: list(anchors.shingle_hashes((t or "").encode(), 3)) for i, t in given}
        assert {i: anchors.fingerprint(s) for i, s in slices.items()} == expected
    found = anchors.fingerprints(documents(given)).collect()
    assert {x.id: unsigned(x.fingerprint) for x in found} == expected
    assert expected[0] == expected[2] == 0


def test_spark_hashes_alike(spark):
    value = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert unsigned(value) == xxhash.xxh64_intdigest(b"a b c", 42)


def near_prints(seed, n=400):
    """Chains, crowds and strangers."""
    r = random.Random(seed)
    made = []
    for _ in range(6):
        base = r.getrandbits(64)
        marginal = r.sample(range(64), 9)
        for _ in range(n // 8):
            made.append(base ^ sum(1 << b for b in r.sample(marginal, r.randrange(5))))
    made += [made[0] ^ (1 << i) - 1 for i in range(0, 40, 2)]
    return made + [r.getrandbits(64) for _ in range(n // 4)]


@pytest.mark.parametrize("crowded", [1 << 20, 50, 0])
@pytest.mark.parametrize("code", range(3))
def test_links_give_all_components(spark, monkeypatch, crowded, code):
    monkeypatch.setattr(anchors, "CODES", anchors.CODES[code:])
    prints = sorted({p - 2**64 if p >> 63 else p for p in near_prints(code)})
    frame = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    links = anchors.links(frame, 1, anchors.Covering(crowded=crowded, in_task=100))
    root = {r.node: r.root for r in anchors.components(links).collect()}
    expected = plain_groups({p: unsigned(p) for p in prints})
    assert {p: root.get(p, p) for p in prints} == expected


def test_groups_equal_all_pairs(documents):
    r = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for g in range(8):
        base = r.choices(words, k=r.choice((1, 2, 30, 200, 800)))
        for _ in range(12):
            text = [w if r.random() > 0.004 else r.choice(words) for w in base]
            rows.append((500 - len(rows), " ".join(text)))
    rows += [(1000, ""), (1001, None), (1002, " "), *rows[:3], (None, rows[0][1]), (None, "no id at all")]
    docs = documents(rows).withColumnRenamed("n_chars", "fingerprint").withColumnRenamed("size", "Root")
    found = anchors.groups(docs).collect()
    assert len(found) == len(rows)
    expected = plain_groups({i: plain_fingerprint(t) for i, t in rows if i is not None})
    assert {x.doc_id: x.component_id for x in found if x.doc_id is not None} == expected
    of = {x.fingerprint: x.component_id for x in found if x.doc_id is None}
    assert sorted(of.values(), key=str) == [expected[rows[0][0]], None]


def test_empty_table_and_long_text(documents):
    assert anchors.groups(documents([])).collect() == []
    long = "A b c d e f g " * 400_000
    found = anchors.groups(documents([(5, long), (3, long + "tail"), (9, "other words here")])).collect()
    assert {x.doc_id: x.component_id for x in found} == {5: 3, 3: 3, 9: 9}
    assert unsigned(next(x.fingerprint for x in found if x.doc_id == 9)) == plain_fingerprint("other words here")


def test_query_equals_all_pairs(spark):
    rows = QUERIES["op11_anchor_simhash"](spark, DATA).collect()
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    prints = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == plain_groups(prints)
