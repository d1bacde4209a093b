"""Near duplicates against all pairs, signatures against step by step drawing."""

import random

import numpy as np

from tillcast.llm import neardup
from tillcast.llm import shingles as sh
from tillcast.llm.components import components


def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(zip(*(words[i:] for i in range(k)))) if len(words) >= k else {tuple(words)}


def plain_groups(docs, k, percent):
    sets = {id: frozenset(shingle_set(text, k)) for id, text in docs}
    root = {id: id for id in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {id: (len(sets[id]), find(id)) for id in sets}


def copies(seed, n=60):
    """Groups of copies with some words changed, dropped or doubled."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for g in range(6):
        base = r.choices(words, k=r.choice((2, 12, 40, 120)))
        for _ in range(n // 6):
            text = [
                w if r.random() > 0.02 else r.choice(words) for w in base if r.random() > 0.01
            ]
            docs.append((len(docs) * 3 + 1, " ".join(text) if r.random() > 0.1 else " ".join(base)))
    return docs + [(1000, ""), (1001, None), (1002, "Alone"), (1003, "aLONE")]


def test_groups_equal_all_pairs(spark, documents):
    docs = copies(1)
    for method in (neardup.NearDup(3, 85), neardup.NearDup(5, 80)):
        found = neardup.groups(documents(docs), method).collect()
        expected = plain_groups(docs, method.words, method.percent)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_representatives_keep_one_of_each(documents):
    docs = copies(2)
    kept = neardup.representatives(documents(docs + docs[:5]), neardup.NearDup()).collect()
    expected = plain_groups(docs, 5, 80)
    assert sorted(r.doc_id for r in kept) == sorted({c for _, c in expected.values()})
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars", "size"}


def test_missing_ids_and_empty_table(documents):
    method = neardup.NearDup()
    text = "one two three four five six"
    rows = neardup.groups(documents([(None, text), (None, text), (7, text)]), method).collect()
    assert {r.component_id for r in rows} == {7}
    assert len(neardup.representatives(documents([(None, text), (None, text)]), method).collect()) == 1
    assert neardup.groups(documents([]), method).collect() == []


def test_superminhash_equals_step_by_step_drawing():
    r = np.random.default_rng(3)
    sets = [
        np.unique(r.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 2, 5, 30, 300, 2000)
    ] + [np.empty(0, np.uint64)]
    slots = 30
    found = sh.superminhash(sets, slots)
    for elements, row in zip(sets, found):
        plain = [2**64 - 1] * slots
        for x in elements:
            order = list(range(slots))
            for step in range(slots):
                drawn = int(sh.mixed(np.array([(int(x) + int(sh.GOLDEN) * (step + 1)) % 2**64], np.uint64))[0])
                other = step + (((drawn & 0xFFFFFFFF) * (slots - step)) >> 32)
                order[step], order[other] = order[other], order[step]
                plain[order[step]] = min(plain[order[step]], step << 32 | drawn >> 32)
        assert row.tolist() == plain


def test_signature_estimates_similarity():
    a = sh.mixed(np.arange(1000, dtype=np.uint64))
    b = sh.mixed(np.arange(100, 1100, dtype=np.uint64))
    x, y = sh.superminhash([np.sort(a), np.sort(b)], 256)
    assert abs((x == y).mean() - 900 / 1100) < 0.1


def test_components_equal_union_find(spark):
    r = random.Random(5)
    links = [(r.randrange(80), r.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)]
    root = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    alone = {a for a, b in links if a == b}
    assert {x.node: x.root for x in found} == {x: y for x, y in root.items() if x not in alone or any(x in link and link[0] != link[1] for link in links)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
