"""Hard negatives for anchors: integer inner products by Strassen's recursion, kept in mergeable heaps.

Vectors are cut to integers once. Anchors and candidates are dealt into blocks by the hash of their
id, and each pair of blocks, a tile, is one group of a cogrouped job: a task holds two blocks of
bounded size whatever the tables' sizes, and every row of one side goes once to each block of the
other. Inside a tile the scores are a product of integer matrices, padded with zeros to even halves
and multiplied by Strassen's seven products on each level. Additions and products are of 64-bit
integers, so they are exact.

Two rounds: the first has tiles of one label only and keeps each anchor's best positives; the second
has tiles of all rows and keeps, for each of these positives, the best candidates of other labels
inside the window that its score opens. A tile keeps a heap of bounded size for each anchor (and
positive), and heaps are merged by rank, in part before the shuffle.

Defined cases: rows whose id, label or vector is null, or whose vector holds a null or non-finite
component, take no part; vectors of different lengths are compared as if the shorter ended in zeros;
ties in score go to the smaller id; equal rows are one row, and so are rows of one id that score the
same; rows of an anchor's own id are neither its positives nor its negatives; an anchor without
positives gives no row; an empty table gives an empty result. Vectors so long that scores might not
fit in 64 bits (sum of squares from 2^62) are an error rather than a wrong score. Extra columns
aren't read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import small_enough
from tillcast.session import settled

LONGEST = 2.0**62


@dataclass(frozen=True)
class Mining:
    """Integer steps in 1.0, positives and negatives wanted, the window in per cent of a positive's score."""

    scale: int = 256
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    tile: int = 4096  # rows of a block
    rows_at_once: int = 256  # anchors whose scores are held at the same time
    leaf: int = 16  # sides up to twice this are multiplied directly


def multiplied(a: np.ndarray, b: np.ndarray, leaf: int = 16) -> np.ndarray:
    """The product of two integer matrices by Strassen's recursion."""
    shortest = min(*a.shape, b.shape[1])
    levels = max((shortest // leaf).bit_length() - 1, 0)
    even = [(0, -side % (1 << levels)) for side in (*a.shape, b.shape[1])]
    padded = _strassen(np.pad(a, even[:2]), np.pad(b, even[1:]), levels)
    return padded[: a.shape[0], : b.shape[1]]


def _strassen(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return a @ b
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    made = np.empty((2 * i, 2 * k), a.dtype)
    m = _strassen(a11 + a22, b11 + b22, levels - 1)
    made[:i, :k] = m
    made[i:, k:] = m
    m = _strassen(a21 + a22, b11, levels - 1)
    made[i:, :k] = m
    made[i:, k:] -= m
    m = _strassen(a11, b12 - b22, levels - 1)
    made[:i, k:] = m
    made[i:, k:] += m
    m = _strassen(a22, b21 - b11, levels - 1)
    made[:i, :k] += m
    made[i:, :k] += m
    m = _strassen(a11 + a12, b22, levels - 1)
    made[:i, :k] -= m
    made[:i, k:] += m
    made[i:, k:] += _strassen(a21 - a11, b11 + b12, levels - 1)
    made[:i, :k] += _strassen(a12 - a22, b21 + b22, levels - 1)
    return made


def integer_rows(
    table: DataFrame, method: Mining, id: str = "vec_id", label: str = "label", vector: str = "embedding"
) -> DataFrame:
    """(id, label, v) of the rows that take part, v in integers."""
    given = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = table.select(
        F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), given.alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite)
    steps = F.transform("v", lambda x: F.floor(x * method.scale))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + F.pow(F.abs(x) * method.scale + 1, 2))
    too_long = F.raise_error(F.lit("a vector's scores may not fit in 64 bits")).cast("array<long>")
    return rows.select("id", "label", F.when(squares < LONGEST, steps).otherwise(too_long).alias("v"))


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """One row for each list, shorter ones ending in zeros."""
    lists = lists.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    made = np.zeros((len(sizes), width), np.int64)
    made[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return made


class Candidates:
    """A tile's candidates by id, equal rows once, and their scores."""

    def __init__(self, anchors: pa.Table, rows: pa.Table, leaf: int):
        ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        width = max(pc.max(pc.list_value_length(t["v"])).as_py() or 0 for t in (anchors, rows))
        vectors = _matrix(rows["v"], width)
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.leaf, self.width = leaf, width
        self.vectors = np.ascontiguousarray(vectors[order].T)
        self.repeated = bool((self.ids[1:] == self.ids[:-1]).any())

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        return multiplied(anchors, self.vectors, self.leaf)

    def ranked(self, scores: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """The chosen candidates, best first, of rows with one id and score the first."""
        if self.repeated:
            pairs = np.stack([scores[chosen], self.ids[chosen]])
            chosen = chosen[np.sort(np.unique(pairs, axis=1, return_index=True)[1])]
        return chosen[np.argsort(-scores[chosen], kind="stable")]


def _rows_of(columns: list[np.ndarray], names: list[str]) -> pa.Table:
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


FOUND = ["anchor", "own", "id", "score"]
MINED = ["anchor", "own", "positive_id", "positive_score", "id", "score"]


def _positive_heaps(method: Mining):
    """The best candidates of each anchor in a tile of one label."""

    def best(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        made = [[] for _ in FOUND]
        if anchors.num_rows and rows.num_rows:
            tile = Candidates(anchors, rows, method.leaf)
            vectors = _matrix(anchors["v"], tile.width)
            ids, own = anchors["id"].to_pylist(), anchors["own"].to_pylist()
            k = method.positives
            for at in range(0, len(ids), method.rows_at_once):
                scores = tile.scores(vectors[at : at + method.rows_at_once])
                for row, line in enumerate(scores, at):
                    chosen = np.flatnonzero(tile.ids != ids[row])
                    if len(chosen) > k and not tile.repeated:
                        values = line[chosen]
                        chosen = chosen[values >= np.partition(values, len(values) - k)[len(values) - k]]
                    chosen = tile.ranked(line, chosen)[:k]
                    parts = (np.full(len(chosen), ids[row]), np.full(len(chosen), own[row]))
                    for column, part in zip(made, (*parts, tile.ids[chosen], line[chosen])):
                        column.append(part)
        return _rows_of([np.concatenate(c) if c else np.empty(0, np.int64) for c in made], FOUND)

    return best


def window(score: int, method: Mining) -> tuple[int, int]:
    """The least and the largest score of a negative for a positive's score."""
    return -(-method.low * score // 100), method.high * score // 100


def _negative_heaps(method: Mining):
    """The best candidates of other labels in the window of each of an anchor's positives."""

    def best(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        made = [[] for _ in MINED]
        if anchors.num_rows and rows.num_rows:
            tile = Candidates(anchors, rows, method.leaf)
            vectors = _matrix(anchors["v"], tile.width)
            told = anchors.select(["id", "own", "label", "positives"]).to_pylist()
            for at in range(0, len(told), method.rows_at_once):
                scores = tile.scores(vectors[at : at + method.rows_at_once])
                for anchor, line in zip(told[at:], scores):
                    windows = [window(p["score"], method) for p in anchor["positives"]]
                    low, high = min(w[0] for w in windows), max(w[1] for w in windows)
                    other = (tile.labels != anchor["label"]) & (tile.ids != anchor["id"])
                    chosen = np.flatnonzero(other & (line >= low) & (line <= high))
                    chosen = tile.ranked(line, chosen)
                    falling = -line[chosen]
                    for positive, (low, high) in zip(anchor["positives"], windows):
                        first = np.searchsorted(falling, -high, "left")
                        last = min(np.searchsorted(falling, -low, "right"), first + method.negatives)
                        taken = chosen[first:last]
                        same = (anchor["id"], anchor["own"], positive["id"], positive["score"])
                        parts = [np.full(len(taken), value) for value in same]
                        for column, part in zip(made, (*parts, tile.ids[taken], line[taken])):
                            column.append(part)
        return _rows_of([np.concatenate(c) if c else np.empty(0, np.int64) for c in made], MINED)

    return best


def _tiled(
    anchors: DataFrame,
    candidates: DataFrame,
    kernel: Callable[[pa.Table, pa.Table], pa.Table],
    names: list[str],
    tile: int,
) -> DataFrame:
    """What ``kernel`` makes of every tile; rows meet only rows of the same ``part``."""
    a = anchors.groupBy("part").agg(F.count("*").alias("a_rows"))
    c = candidates.groupBy("part").agg(F.count("*").alias("c_rows"))
    blocks = {n: F.ceil(F.col(f"{n}_rows") / tile).cast("int") for n in "ac"}
    parts = small_enough(settled(a.join(c, "part").select("part", *[v.alias(n) for n, v in blocks.items()])), 64)

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), own).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        kept = [name for name in rows.columns if name != "part"]
        return rows.join(parts, "part").select("part", block.alias(f"{own}_block"), every.alias(f"{other}_block"), *kept)

    keys = ["part", "a_block", "c_block"]
    left, right = dealt(anchors, "a", "c").groupBy(keys), dealt(candidates, "c", "a").groupBy(keys)
    schema = ", ".join(f"{name} long" for name in names)
    return left.cogroup(right).applyInArrow(kernel, schema)


def _best(found: DataFrame, by: list[str], count: int, rank: str) -> DataFrame:
    """Heaps merged: the first so many by score, then id."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    return found.withColumn(rank, place).where(F.col(rank) <= count)


def hard_negatives(
    table: DataFrame,
    is_anchor: Column,
    method: Mining = Mining(),
    id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the column ``id``.
    """
    rows = settled(integer_rows(table, method, id, label, vector))
    anchors = settled(rows.where(is_anchor).distinct().withColumn("own", F.xxhash64("id", "label", "v")))
    same = _tiled(
        anchors.select("id", "own", "v", F.col("label").alias("part")),
        rows.select("id", "label", "v", F.col("label").alias("part")),
        _positive_heaps(method),
        FOUND,
        method.tile,
    )
    positives = _best(same, ["anchor", "own"], method.positives, "place")
    wanted = settled(
        positives.groupBy("anchor", "own").agg(F.collect_list(F.struct("id", "score")).alias("positives"))
    )
    led = anchors.withColumnRenamed("id", "anchor").join(wanted, ["anchor", "own"])
    led = settled(led.select(F.col("anchor").alias("id"), "own", "label", "v", "positives"))
    # Zero, but not a constant, so that tiles are still joined on a key.
    everywhere = F.pmod("id", F.lit(1)).alias("part")
    mined = _tiled(
        led.select("*", everywhere), rows.select("*", everywhere), _negative_heaps(method), MINED, method.tile
    )
    best = _best(mined, MINED[:4], method.negatives, "rank")
    return best.select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
