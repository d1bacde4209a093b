"""Targets by plain water filling, the plan by walking through each source."""

import hashlib

import pytest

from tillcast.llm import curriculum as cu


def plain_targets(sizes, weights=(3, 1, 2), volume=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_sources, target = volume * sum(sizes.values()), set(names), {}
    while open_sources:
        level = left / sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if level * weight[s] >= most * sizes[s]}
        for s in full or open_sources:
            target[s] = most * sizes[s] if full else level * weight[s]
        if not full:
            break
        left -= sum(target[s] for s in full)
        open_sources -= full
    return target


def rows():
    made = [(i, "w " * (1 + i * 7 % 23), f"s{i % 4}") for i in range(80)]
    made += [(200 + i, "é x " * 300, "S") for i in range(3)]
    made += [(300, "lone words here", None), (301, None, "zero"), (302, "", "zero")]
    return made + [made[0], (None, "no id at all", "s1")]


def size(text):
    return len((text or "").split())


def test_plan_equals_a_walk_through_each_source(documents):
    given = rows()
    sizes = {}
    for _, text, source in given:
        sizes[source] = sizes.get(source, 0) + size(text)
    targets = plain_targets(sizes)
    planned = cu.plan(documents(given), ["doc_id", "text", "source"], cu.Mix(bucket_rows=5)).collect()
    assert len(planned) == len(given)
    taken = {}
    for r in planned:
        assert r.target == pytest.approx(targets[r.row.source])
        assert r.source_size == sizes[r.row.source] and r.size == size(r.row.text)
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(v.words for v in r.visits)
        assert all(0 <= v.time <= 1 for v in r.visits)
        taken[r.row.source] = taken.get(r.row.source, 0) + r.taken
    assert {s: abs(n - targets[s]) <= 0.5 for s, n in taken.items()} == {s: True for s in taken}

    def order(row):
        text = "" if row[0] is None else str(row[0])
        return hashlib.md5(text.encode()).hexdigest(), row[0] or -1, size(row[1])

    walked = []
    for source in sizes:
        goal, at = round(targets[source]), 0
        of = sorted((r for r in given if r[2] == source), key=order)
        words = {i: 0 for i in range(len(of))}
        for _ in range(2):
            for i, row in enumerate(of):
                part = max(0, min(size(row[1]), goal - at))
                words[i] += part
                at += part
        walked += [(of[i][0], n) for i, n in words.items()]
    found = [(r.row.doc_id, r.taken) for r in planned]
    assert sorted(found, key=str) == sorted(walked, key=str)


def test_mix_is_in_training_order_and_cut_to_the_plan(documents):
    given = rows()
    docs = documents(given)
    mixed = cu.mixed(docs)
    assert mixed.columns == docs.columns
    made = mixed.collect()
    planned = cu.plan(docs, ["doc_id"]).collect()
    assert sum(size(r.text) for r in made) == sum(r.taken for r in planned)
    visits = sorted((v.time, v.words) for r in planned for v in r.visits)
    assert [size(r.text) for r in made] == [words for _, words in visits]
    assert all(r.n_chars == len(r.text) for r in made)


def test_times_follow_the_schedule(spark):
    """The demand up to the time of a fraction is the fraction."""
    from pyspark.sql import functions as F

    frame = spark.range(101).select((F.col("id") / 100).alias("f"))
    for ramp in (-0.5, 0.0, 0.5):
        for r in frame.select("f", cu.due(F.col("f"), F.lit(ramp)).alias("t")).collect():
            assert r.t + ramp * (r.t**2 - r.t) == pytest.approx(r.f)


def test_empty_table(documents):
    assert cu.plan(documents([]), ["doc_id"]).collect() == []
    assert cu.mixed(documents([])).collect() == []
    assert cu.mixed(documents([(1, None, "a"), (2, "", None)])).collect() == []


def test_query_places_every_visit_in_training_order(documents, tmp_path, monkeypatch):
    from tillcast.llm import queries

    documents(rows()).write.parquet(str(tmp_path / "documents.parquet"))
    made = []
    whole = cu.trained
    monkeypatch.setattr(cu, "trained", lambda planned: made.append(whole(planned)) or made[0])
    spark = documents([]).sparkSession
    found = queries.QUERIES["op2_curriculum"](spark, str(tmp_path)).collect()
    assert len(found) == len(rows())
    placed = [
        (at, v.time, v.words) for r in made[0].collect() for at, v in zip(r.positions, r.visits, strict=True)
    ]
    placed.sort()
    assert [at for at, _, _ in placed] == list(range(len(placed)))
    assert [t for _, t, _ in placed] == sorted(t for _, t, _ in placed)
    assert sum(r.taken for r in found) == sum(words for _, _, words in placed)
