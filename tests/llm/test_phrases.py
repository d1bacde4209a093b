"""Collocations against plain counting, the parse against its text."""

import random
import re
from collections import Counter

import pytest

from tillcast.llm import phrases

BIG = ["a", "b", "c", "Ä", "x-y", "\x1c", "\xa0", "e"]


def pieces_of(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
        if words := [w for w in re.split(r"[\x20\x09]", piece) if w]:
            yield words


def counted(texts, longest):
    """Occurrences of every phrase, and of all words."""
    found = Counter()
    for text in texts:
        for words in pieces_of(text):
            for k in range(1, longest + 1):
                found.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return found, sum(n for phrase, n in found.items() if len(phrase) == 1)


def plain(docs, method):
    rows = []
    for lang in {l or "und" for l, _ in docs}:
        f, n = counted([t for l, t in docs if (l or "und") == lang], method.longest)
        often = {p: a for p, a in f.items() if a >= method.least and len(p) > 1}
        scored = []
        for p, a in often.items():
            cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [
                b for q, b in often.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if not any(100 * b >= method.contained * a for b in longer):
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[: method.wanted], 1):
            rows.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(rows)


def frame(spark, docs):
    rows = [(i, text, lang, "n", 1) for i, (lang, text) in enumerate(docs)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, phrase string, N long")


def corpus(seed, n=120):
    r = random.Random(seed)
    marks = [" ", " ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\x0c", ";b "]
    docs = []
    for _ in range(n):
        words = r.choices(BIG, weights=[30, 20, 10, 5, 5, 3, 2, 1], k=r.choice([0, 1, 7, 60]))
        docs.append((r.choice(["en", "en", "en", "de", None, "und"]), "".join(w + r.choice(marks) for w in words)))
    return docs + docs[:20] + [("en", None), (None, None), ("fr", "!!"), ("en", "A B. a b A B")]


@pytest.mark.parametrize("every", [1, 3, 1000])
def test_equals_plain_counting(spark, every):
    docs = corpus(every)
    method = phrases.Mining(least=8, every=every, held=400, map_bits=1 << 8, wanted=40)
    found = phrases.collocations(frame(spark, docs), method).collect()
    expected = plain(docs, method)
    assert len(expected) > 40 and sorted(map(tuple, found)) == expected


def test_redundant_phrases_go_with_partly_covered_ones(spark):
    docs = [("en", "new york city hall. new york city. new york")] * 10
    for contained, left in ((100, ["new york", "new york city", "new york city hall"]), (60, ["new york city", "new york city hall"])):
        method = phrases.Mining(least=10, contained=contained)
        found = phrases.collocations(frame(spark, docs), method).collect()
        assert sorted(map(tuple, found)) == plain(docs, method)
        assert sorted(r.phrase for r in found) == left


def test_chunks_put_together_are_the_pieces(spark):
    method = phrases.Mining(every=3)
    docs = corpus(8) + [("en", "w " * 300)]
    chunks = phrases.parsed(frame(spark, docs), method).collect()
    expected, n = counted([t for _, t in docs], method.longest)
    found = Counter()
    for c in chunks:
        words = bytes(c.chunk).split(b" ")
        assert 0 < c.owned <= len(words) and c.owned in (len(words), len(words) - method.longest + 1)
        for k in range(1, method.longest + 1):
            for i in range(min(c.owned, len(words) - k + 1)):
                found[tuple(w.decode() for w in words[i : i + k])] += c.weight
    assert found == expected and sum(c.owned * c.weight for c in chunks) == n


def test_products_pass_64_bits(spark):
    schema = "lang string, words int, phrase string, f long"
    rows = [("en", 1, "a", 10**12), ("en", 1, "b", 3 * 10**12 + 1), ("en", 2, "a b", 10**11)]
    sizes = spark.createDataFrame([("en", 9 * 10**13)], "lang string, n long")
    made = phrases.scored(spark.createDataFrame(rows, schema), sizes).collect()
    assert [r.score for r in made] == [1000 * 10**11 * 9 * 10**13 // (10**12 * (3 * 10**12 + 1))]


def test_empty_table_and_long_text(spark):
    assert phrases.collocations(frame(spark, [])).collect() == []
    docs = [("en", "one two three four " * 150_000 + "one two")]
    found = phrases.collocations(frame(spark, docs)).collect()
    assert sorted(map(tuple, found)) == plain(docs, phrases.Mining())
