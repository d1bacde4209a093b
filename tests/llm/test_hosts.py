"""Quality rules by host against plain counting."""

from collections import Counter

from pyspark.sql import functions as F

from tillcast.llm import hosts

GOOD = "one two three four five six seven eight nine ten eleven twelve"


def plain_repeats(words, size=5):
    windows = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    found = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if found[w] > 1 for k in range(size)}
    return len(covered)


def test_measures():
    text = "a b c d e\nx a b c d e\n\na b c d e\n#$ é%"
    words = text.split()
    assert hosts.measured(text) == (18, 20, 3, 1, plain_repeats(words))
    assert hosts.measured("") == (0, 0, 0, 0, 0)
    assert hosts.measured(" x y")[0] == 1  # only ASCII white space parts words


def test_repeated_words_equal_plain_count():
    for text in ("a a a a a a a", "a b c d e f a b c d e", GOOD, "x y " * 9, "a b c d"):
        words = text.encode().split()
        assert hosts.repeated_words(words) == plain_repeats(words)


def judged(docs):
    found, name = hosts.judge(docs)
    return found.select("doc_id", f"{name}.*").collect()


def test_base_rules_and_nulls(documents):
    docs = documents([(1, GOOD), (2, None), (3, ""), (4, "a b c d e " * 9), (None, GOOD), (1, GOOD)])
    rows = judged(docs)
    assert len(rows) == 6
    assert sorted(r.doc_id for r in rows if r.kept and r.doc_id) == [1, 1]
    assert all(r.base_failed for r in rows if r.doc_id in (2, 3, 4))


def test_bad_host_tightens_rules_but_keeps_clean_documents(documents):
    junk = "### " * 3 + GOOD  # symbols only, no base rule
    rows = [(i, junk, "bad") for i in range(60)] + [(100, GOOD, "bad")]
    rows += [(200 + i, GOOD, f"good{i % 9}") for i in range(90)] + [(300, junk, "good1")]
    kept = {r.doc_id for r in judged(documents(rows)) if r.kept}
    assert kept == {100, 300, *range(200, 290)}


def test_empty_and_clashing_names(documents):
    assert judged(documents([])) == []
    docs = documents([(1, GOOD)]).withColumn("quality", F.lit("mine"))
    found, name = hosts.judge(docs)
    assert name != "quality" and found.first()["quality"] == "mine"
