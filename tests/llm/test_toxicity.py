"""Toxicity on made-up words: held-out accuracy, and the models' probabilities."""

import math
import random
import zlib

from tillcast.llm import kneserney as kn
from tillcast.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=400):
    r = random.Random(11)
    syllables = ["ba", "do", "ke", "li", "mu", "ta", "ren", "so"]
    bad = ["zorgat", "vexil", "quosp"]
    docs, labels = [], []
    for i in range(n):
        words = ["".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(r.choice((5, 40, 200)))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(r.randint(1, 4)):
                words.insert(r.randrange(len(words) + 1), r.choice(bad))
        docs.append((i, " ".join(words).capitalize() + "."))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def held_out(id):
    return zlib.crc32(str(id).encode()) % 3 == 1


def test_held_out_accuracy(spark, documents):
    rows, labels = corpus()
    docs = documents(rows + [(900, None), (901, ""), (None, "zorgat vexil quosp")])
    odd = [(5000, 1, 1), (None, 1, 1), (3, 1, None), (6, 1, 7)]
    fitted = toxicity.fit(docs, spark.createDataFrame(labels + odd, LABELS))
    found = docs.select(
        "doc_id", toxicity.held_out(docs["doc_id"]).alias("held_out"), toxicity.score(docs, fitted).alias("score")
    ).collect()
    scores = {r.doc_id: r.score for r in found}
    assert len(found) == len(rows) + 3 and all(0 <= s <= 1 for s in scores.values())
    assert all(r.held_out == held_out(r.doc_id) for r in found if r.doc_id is not None)
    toxic = {id: label for id, _, label in labels}
    right = [(scores[id] >= 0.7) == bool(toxic[id]) for id in toxic if held_out(id)]
    assert len(right) > 100 and sum(right) / len(right) > 0.97
    assert scores[900] == scores[901] < 0.7 < scores[None]


def test_held_out_labels_are_not_learned(spark, documents):
    rows, labels = corpus(120)
    turned = [(id, q, 1 - t if held_out(id) else t) for id, q, t in labels]
    docs = documents(rows)
    fits = [toxicity.fit(docs, spark.createDataFrame(x, LABELS)) for x in (labels, turned)]
    assert (fits[0].weights == fits[1].weights).all()


def test_without_both_classes(spark, documents):
    docs = documents([(1, "a b c"), (2, "d")])
    for labels in ([], [(2, 1, 0), (1, 1, 0)]):
        fitted = toxicity.fit(docs, spark.createDataFrame(labels, LABELS))
        scores = [r[0] for r in docs.select(toxicity.score(docs, fitted)).collect()]
        assert all(0 <= s < 0.7 for s in scores)
    empty = docs.where("false")
    assert empty.select(toxicity.score(empty, fitted)).collect() == []


def test_probabilities_add_up():
    counts = {}
    for word, c in (("abab", 0), ("abba", 0), ("abc", 1), ("cab", 1), ("b", 1)):
        for s in kn.sequences(word):
            counts.setdefault(s, [0, 0])[c] += 1
    model = kn.Model((s, *c) for s, c in counts.items())
    letters = [*"abc$"]
    assert model.alphabet == len(letters) + 1
    for context in ("", "a", "^a", "b", "zz"):
        total = sum(model.backoff(context + x) for x in letters)
        # What is left belongs to letters that were never seen.
        assert 0 < total <= 1 + 1e-9 and total > 0.8
    assert model.words["cab"] > 0 > model.words["abba"]
    assert kn.features(model, "") == kn.features(model, "123 !") == (0.0,) * len(kn.FEATURES)
    assert all(math.isfinite(x) for x in kn.features(model, "xyz " * 5))


def test_counts_cover_the_whole_corpus(spark, documents):
    """Class counts aren't bounded by the sample, and unlabelled texts add to the backoff counts."""
    rows, labels = corpus(120)
    made = spark.createDataFrame([*labels, (4, 1, 1)], LABELS)
    few = toxicity.Learning(sample=3)
    fitted = toxicity.fit(documents(rows + [(900, "jyzzyj")]), made, few)
    spare = [i for i, _, _ in labels if not held_out(i) and zlib.crc32(str(i).encode()) // 3 % 4 == 0]
    learned = {i: t for i, _, t in labels if not held_out(i) and i not in spare}
    bare = lambda toxic: {s for i, text in rows if learned.get(i) == toxic for w in kn.words_of(text) for s in kn.sequences(w)}
    for c in (0, 1):
        assert bare(c) <= fitted.model.seen_by[c].keys()
    assert len(spare) > 2 * few.sample
    assert "yzzyj" in fitted.model.seen and all("yzzyj" not in s for seen in fitted.model.seen_by for s in seen)
