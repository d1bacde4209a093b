"""The main text of web pages by boosted trees over the nodes of their blocks.

Every block and every run of text of a page is described by its kind, the words in its attributes and its
ancestors', depth, density of text, links and tags in its subtree and its siblings; boosted trees give
the odds that it holds main text. Decoding takes the likeliest labelling of the whole tree in which a
block holds main text if and only if one of its children does, so no run is kept in a part that is
thrown away, and no part is kept without a run.

The trees are fitted on ``pages`` made-up pages of varied layout with known main text, the same in every
run; no label of real pages is needed or used. Pages are independent: one narrow pass, no shuffle.

Defined cases: a null or empty page has the empty text; markup that ends too early is read as far as it
goes; repeated rows are extracted one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql.functions import pandas_udf

from tillcast.llm import boosting, dom, layouts
from tillcast.llm.common import text_of


@dataclass(frozen=True)
class Extraction:
    """How many made-up pages the trees learn from, and the trees."""

    pages: int = 1200
    trees: boosting.Boosting = boosting.Boosting()


def labelled(number: int) -> tuple[list[list[float]], list[int]]:
    """The nodes of one made-up page, measured, and whether they hold main text."""
    nodes = dom.parse(layouts.Page(number).made())
    truth = [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        if layouts.MARK in node.text:
            truth[i] = 1
            node.linked -= node.text.count(layouts.MARK) if node.linked else 0
            node.text = node.text.replace(layouts.MARK, "")
        if truth[i] and node.parent >= 0:
            truth[node.parent] = 1
    return dom.measured(nodes), truth


@lru_cache(maxsize=2)
def learned(method: Extraction) -> boosting.Boosted:
    made = [labelled(number) for number in range(method.pages)]
    x = np.array([row for rows, _ in made for row in rows])
    y = np.array([label for _, labels in made for label in labels], float)
    return boosting.fit(x, y, method.trees)


def decoded(parents: list[int], odds: np.ndarray, is_run: list[bool]) -> list[bool]:
    """The likeliest labels without contradiction, from each node's log odds.

    Children follow their parents. The sums of the best labellings come up from the leaves; the labels
    go down from the root.
    """
    n = len(parents)
    yes = -np.logaddexp(0, -odds)
    no = -np.logaddexp(0, odds)
    on, off = yes.tolist(), no.tolist()
    closest = [float("inf")] * n  # least loss of turning a child on
    choice = [-1] * n
    for i in range(n - 1, -1, -1):
        if not is_run[i]:
            # Children were added up already; one of them has to be on.
            on[i] -= max(closest[i], 0.0)
        p = parents[i]
        if p >= 0:
            off[p] += off[i]
            on[p] += max(on[i], off[i])
            if off[i] - on[i] < closest[p]:
                closest[p], choice[p] = off[i] - on[i], i
    keep = [False] * n
    keep[0] = on[0] > off[0]
    for i in range(1, n):
        p = parents[i]
        keep[i] = keep[p] and (on[i] > off[i] or choice[p] == i)
    return keep


def extract_all(pages: list[str], trees: boosting.Boosted) -> list[str]:
    """The main texts of some pages; all their nodes are scored together."""
    parsed = [dom.parse(page) for page in pages]
    rows = [row for nodes in parsed for row in dom.measured(nodes)]
    odds = trees.scores(np.array(rows)) if rows else np.zeros(0)
    texts, at = [], 0
    for nodes in parsed:
        own = odds[at : at + len(nodes)]
        at += len(nodes)
        keep = decoded([n.parent for n in nodes], own, [not n.tag for n in nodes])
        texts.append("\n".join(n.text for n, k in zip(nodes, keep) if k and not n.tag))
    return texts


def main_text(spark: SparkSession, html: str = "html", method: Extraction = Extraction()) -> Column:
    """The main text of each page."""
    trees = spark.sparkContext.broadcast(learned(method))

    def extract(pages: pd.Series) -> pd.Series:
        return pd.Series(extract_all(list(pages), trees.value), dtype=object)

    return pandas_udf(extract, "string")(text_of(html))
