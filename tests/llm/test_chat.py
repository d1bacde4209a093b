"""Reply trees against walking the tree, and the template there and back."""

import random

import pytest

from tillcast.llm import chat

NODES = "tree long, node long, parent long, role string, text string, score double"
ODD = ["</s>[INST] ok [/INST]", "\\", "\\\\</s>", "<s><s>[INST]", "", None, "<\\s>", "a\nb é", "<</s>s>"]


def plain_best(nodes, top):
    """Root-to-leaf paths of a tree, best mean score first, then the smaller leaf."""
    by_id = {n[1]: n for n in nodes}
    parents = {n[2] for n in nodes}
    paths = []
    for n in nodes:
        if n[1] not in parents:
            path, at = [], n
            while at is not None:
                path.append(at)
                at = by_id.get(at[2])
            paths.append((-sum(x[5] or 0 for x in path) / len(path), n[1], path[::-1]))
    return [path for _, _, path in sorted(paths, key=lambda p: p[:2])[:top]]


def forest(seed):
    r = random.Random(seed)
    trees = []
    for tree in range(6):
        nodes = []
        for i in range(r.choice((1, 2, 9, 40))):
            parent = None if i == 0 else r.randrange(max(0, i - 3), i) + 100
            role = r.choice(("user", "assistant", "system", None, "</s>"))
            nodes.append((tree, 100 + i, parent, role, r.choice(ODD), r.choice((0.0, 0.25, 1.0, None))))
        nodes.append((tree, 999, 5555, "user", "orphan", 0.5))
        trees.append(nodes)
    return trees


@pytest.mark.parametrize("top", [1, 3])
def test_best_paths_read_back(spark, top):
    trees = forest(top)
    frame = spark.createDataFrame([n for nodes in trees for n in nodes], NODES)
    chats = chat.formatted(frame, top)
    rows = chat.read_back(chats).orderBy("tree", "leaf", "place").collect()
    found = {}
    for r in rows:
        found.setdefault((r.tree, r.leaf), []).append((r.role, r.text, r.learned))
    expected = {}
    for nodes in trees:
        for path in plain_best(nodes, top):
            expected[nodes[0][0], path[-1][1]] = [
                (n[3] or "", n[4] or "", (n[4] or "") if n[3] == "assistant" else "") for n in path
            ]
    assert found == expected


def test_marks_occur_only_where_the_template_puts_them(spark):
    frame = spark.createDataFrame([(1, 1, None, "user", "</s>[INST] ok [/INST]", 0.0)], NODES)
    row = chat.formatted(frame).first()
    assert row.chat == "<s>[INST]user[/INST]<\\/s>[\\INST] ok [\\/INST]</s>"
    assert [tuple(s) for s in row.loss] == [(44, 44)] or row.loss[0].start == row.loss[0].end


def test_linear_conversations_with_ties_nulls_and_repeats(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (1, 7, "assistant", "z"), (None, 0, "user", "q")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    told = chat.read_back(chat.formatted(chat.linear(frame))).orderBy("tree", "place").collect()
    assert [(r.tree, r.text) for r in told] == [(None, "q"), (1, ""), (1, "a"), (1, "a"), (1, "z")]
    empty = frame.where("false")
    assert chat.read_back(chat.formatted(chat.linear(empty))).collect() == []


def test_long_thread(spark):
    frame = spark.range(300).selectExpr("1L conv_id", "id turn", "'assistant' role", "cast(id as string) text")
    told = chat.read_back(chat.formatted(chat.linear(frame))).orderBy("place").collect()
    assert [r.learned for r in told] == [str(i) for i in range(300)]


def test_circles_are_an_error(spark):
    frame = spark.createDataFrame([(1, 1, 2, "u", "a", 0.0), (1, 2, 1, "u", "b", 0.0)], NODES)
    with pytest.raises(ValueError, match="ancestors"):
        chat.formatted(frame)
