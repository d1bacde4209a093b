"""Exact k-nearest-neighbour regression as block joins.

Fitting cuts feature space into cells on two levels and stores the rows by cell. The first level has a
bounded number of regions, by median splits of a small sample on the driver. Where there are more rows
than these can hold, every region is cut further by a tree of its own, grown in a task from a bounded
sample of its rows; trees, cells and their bounding boxes are tables, so cells grow with the rows. A
query is first matched with its own cell, which bounds how far its neighbours can be; it then visits
only the other cells whose bounding box is that near, to which the trees of the regions that are lead.
Cells and queries are both cut into blocks of bounded size, so a cell of identical rows or of many
queries becomes more blocks, not a larger one. A task is given many blocks at a time.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from tillcast.session import settled
from tillcast.sources.files import path_exists

SAMPLE_ROWS = 20_000
REGIONS = 4096
CELL_ROWS = 2_000
BLOCK_ROWS = 20_000
QUERY_ROWS = 50_000
MATRIX_CELLS = 4_000_000
# Points that meet a copy of their region's tree, and points of the blocks that are matched at a time.
MEETING_ROWS = 30_000
SUB_BITS = 20  # a cell's number has its region's in front of its own
BLOCK = ["cell", "row_block", "query_block"]


def split_space(sample: np.ndarray, cells: int) -> dict:
    """Median splits of the widest dimension until there are enough cells."""
    tree: dict = {"dimension": [], "threshold": [], "left": [], "right": [], "cell": []}
    made = 0

    def grow(rows: np.ndarray, wanted: int) -> int:
        nonlocal made
        node = len(tree["cell"])
        for values in tree.values():
            values.append(-1)
        spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) else np.zeros(1)
        if wanted <= 1 or spread.max() == 0:
            tree["cell"][node] = made
            made += 1
            return node
        dimension = int(spread.argmax())
        column = rows[:, dimension]
        threshold = float(np.median(column))
        if threshold >= column.max():
            threshold = float(column[column < column.max()].max())
        near = column <= threshold
        tree["dimension"][node], tree["threshold"][node] = dimension, threshold
        tree["left"][node] = grow(rows[near], wanted // 2)
        tree["right"][node] = grow(rows[~near], wanted - wanted // 2)
        return node

    grow(sample, cells)
    return tree


def as_arrays(text: str) -> dict[str, np.ndarray]:
    return {name: np.asarray(values) for name, values in json.loads(text).items()}


@lru_cache(maxsize=4)
def _geometry(text: str) -> dict[str, np.ndarray]:
    return as_arrays(text)


def cell_of(points: np.ndarray, tree: dict[str, np.ndarray]) -> np.ndarray:
    node = np.zeros(len(points), dtype=int)
    while True:
        open_rows = np.flatnonzero(tree["cell"][node] < 0)
        if not len(open_rows):
            return tree["cell"][node].astype(np.int32)
        at = node[open_rows]
        value = points[open_rows, tree["dimension"][at]]
        node[open_rows] = np.where(
            value <= tree["threshold"][at], tree["left"][at], tree["right"][at]
        )


def squared_distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = np.zeros((len(queries), len(rows)))
    for j in range(rows.shape[1]):
        total += (queries[:, j, None] - rows[None, :, j]) ** 2
    return total


def numbered_boxes(
    tree: dict[str, np.ndarray], cells: Sequence[int], low: Sequence, high: Sequence
) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the boxes by cell number, infinite and the wrong way round where a cell has no rows."""
    shape = int(tree["cell"].max()) + 1, len(low[0])
    lows, highs = np.full(shape, np.inf), np.full(shape, -np.inf)
    lows[cells], highs[cells] = np.stack(low), np.stack(high)
    return lows, highs


def cells_within(
    points: np.ndarray,
    reach: np.ndarray,
    tree: dict[str, np.ndarray],
    low: np.ndarray,
    high: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Places of points, and the numbers of the cells whose boxes are within their reach.

    A box whose start is beyond its end has no rows and is never reached.
    """
    at, node = np.arange(len(points)), np.zeros(len(points), dtype=int)
    places, cells = [at[:0]], [at[:0]]
    while len(at):
        cell = tree["cell"][node]
        done = np.flatnonzero(cell >= 0)
        for start in range(0, len(done), MATRIX_CELLS):
            some = done[start : start + MATRIX_CELLS]
            point, box = points[at[some]], cell[some]
            gaps = np.maximum(np.maximum(low[box] - point, point - high[box]), 0.0)
            near = np.sqrt((gaps**2).sum(axis=1)) <= reach[at[some]]
            near &= low[box, 0] <= high[box, 0]
            places.append(at[some][near])
            cells.append(box[near])
        at, node = at[cell < 0], node[cell < 0]
        # Rows up to the threshold are on the left, so a point is at least that far from either side.
        gap = points[at, tree["dimension"][node]] - tree["threshold"][node]
        left, right = gap <= reach[at], -gap <= reach[at]
        at, node = (
            np.concatenate([at[left], at[right]]),
            np.concatenate([tree["left"][node[left]], tree["right"][node[right]]]),
        )
    return np.concatenate(places), np.concatenate(cells)


def block_neighbours(
    asked: np.ndarray, points: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distances and places of the k nearest points for each query; equal distances go by place."""
    wanted = min(k, len(points))
    step = max(1, MATRIX_CELLS // len(points))
    distances, places = [], []
    for start in range(0, len(asked), step):
        squares = squared_distances(asked[start : start + step], points)
        near = np.argpartition(squares, wanted - 1, axis=1)[:, :wanted]
        limits = np.take_along_axis(squares, near, axis=1).max(axis=1)[:, None]
        # Where several points lie at the limit, the first ones are taken.
        tied = np.flatnonzero((squares <= limits).sum(axis=1) > wanted)
        if len(tied):
            below, level = squares[tied] < limits[tied], squares[tied] == limits[tied]
            room = wanted - below.sum(axis=1)[:, None]
            taken = below | (level & (level.cumsum(axis=1) <= room))
            near[tied] = np.nonzero(taken)[1].reshape(-1, wanted)
        distances.append(np.sqrt(np.take_along_axis(squares, near, axis=1)))
        places.append(near)
    return np.concatenate(distances), np.concatenate(places)


def neighbours(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows for each query, block by block; equal distances go by label."""
    hits = {"query": [np.empty(0, "int64")], "distance": [np.empty(0)], "label": [np.empty(0)]}
    both = pd.concat([queries[BLOCK], rows[BLOCK]])
    number = both.groupby(BLOCK).ngroup().to_numpy()
    of_query, of_row = number[: len(queries)], number[len(queries) :]
    query_order = np.argsort(of_query, kind="stable")
    row_order = np.lexsort((rows["label"].to_numpy(), of_row))
    blocks = np.intersect1d(of_query, of_row)
    if len(blocks):
        asked, points = (np.stack(side["x"].to_numpy()) for side in (queries, rows))
        asked, ids = asked[query_order], queries["query"].to_numpy()[query_order]
        points, labels = points[row_order], rows["label"].to_numpy()[row_order]
        query_ends, row_ends = (
            zip(*(np.searchsorted(side, blocks, at) for at in ("left", "right")))
            for side in (of_query[query_order], of_row[row_order])
        )
        for (first, last), (start, end) in zip(query_ends, row_ends):
            distances, places = block_neighbours(asked[first:last], points[start:end], k)
            hits["query"].append(np.repeat(ids[first:last], places.shape[1]))
            hits["distance"].append(distances.ravel())
            hits["label"].append(labels[start:end][places.ravel()])
    return pd.DataFrame({name: np.concatenate(parts) for name, parts in hits.items()})


def nearest(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each query. The rank limit is applied before the shuffle as well."""
    order = Window.partitionBy("query").orderBy("distance", "label")
    return hits.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)


def weighted_mean(hits: DataFrame, weights: str = "distance") -> DataFrame:
    """Inverse-distance mean of the labels; rows at distance zero then count alone."""
    if weights == "uniform":
        return hits.groupBy("query").agg(F.avg("label").alias("prediction"))
    exact = F.col("distance") == 0
    inverse = F.when(exact, F.lit(0.0)).otherwise(
        F.lit(1.0) / F.when(~exact, F.col("distance"))
    )
    return hits.groupBy("query").agg(
        F.coalesce(
            F.avg(F.when(exact, F.col("label"))),
            F.sum(inverse * F.col("label")) / F.nullif(F.sum(inverse), F.lit(0.0)),
        ).alias("prediction")
    )


def region_of(tree: str) -> Callable[[Column | str], Column]:
    @F.pandas_udf("int")
    def region(x: pd.Series) -> pd.Series:
        return pd.Series(cell_of(np.stack(x.to_numpy()), _geometry(tree)))

    return region


def region_trees(rows: DataFrame, sizes: DataFrame, cell_rows: int) -> DataFrame:
    """(region, tree): the cells of each region, from at most about ``SAMPLE_ROWS`` of its rows.

    ``sizes`` has one row for each region.
    """
    wanted = F.least(F.ceil(F.col("rows") / cell_rows), F.lit(1 << SUB_BITS))
    share = F.lit(SAMPLE_ROWS * 1_000_000.0) / F.col("rows")
    drawn = F.pmod(F.xxhash64("row"), F.lit(1_000_000)) < share
    sample = rows.join(F.broadcast(sizes), "region").where(drawn)

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        tree = split_space(np.stack(sample["x"].to_numpy()), int(sample["wanted"].iloc[0]))
        return pd.DataFrame({"region": sample["region"].iloc[:1], "tree": [json.dumps(tree)]})

    sample = sample.select("region", "x", wanted.cast("int").alias("wanted"))
    return sample.groupBy("region").applyInPandas(grow, "region int, tree string")


def region_by_region(
    points: DataFrame,
    regions: DataFrame,
    number: str,
    block_rows: int,
    work: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str | StructType,
) -> DataFrame:
    """Blocks of a region's points, dealt by ``number``, each meet the region's row in a task.

    Each block has a copy of that row, so blocks don't become small beside it.
    """
    rows = max(block_rows, MEETING_ROWS)
    counts = points.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / rows).alias("blocks"))
    # One row for each region.
    counts = F.broadcast(settled(counts))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    dealt = points.join(counts, "region").withColumn("block", F.pmod(number, "blocks")).drop("blocks")
    copied = regions.join(counts, "region").select(*regions.columns, every)
    keys = ["region", "block"]
    return dealt.groupBy(*keys).cogroup(copied.groupBy(*keys)).applyInPandas(work, schema)


def celled(points: DataFrame, trees: DataFrame | None, number: str, block_rows: int) -> DataFrame:
    """Points with their region and x, and their cell."""
    first = F.shiftleft(F.col("region").cast("long"), SUB_BITS)
    made = points.withColumn("cell", first)
    if trees is None:
        return made
    names = made.columns

    def place(points: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        points["cell"] = points["region"].astype("int64") * (1 << SUB_BITS)
        if len(points) and len(tree):
            points["cell"] += cell_of(np.stack(points["x"].to_numpy()), as_arrays(tree["tree"].iloc[0]))
        return points[names]

    return region_by_region(points, trees, number, block_rows, place, made.schema)


def reached(
    points: DataFrame, trees: DataFrame, bounds: DataFrame, number: str, block_rows: int
) -> DataFrame:
    """Every cell of their region, but their own, that points reach with their limit."""
    boxes = F.struct("cell", "low", "high")
    # A region has at most as many cells as rows in its sample.
    regions = trees.join(bounds.groupBy("region").agg(F.collect_list(boxes).alias("boxes")), "region")

    def reach(points: pd.DataFrame, region: pd.DataFrame) -> pd.DataFrame:
        if points.empty or region.empty:
            return pd.DataFrame({"query": np.empty(0, "int64"), "x": [], "cell": np.empty(0, "int64")})
        tree, found = as_arrays(region["tree"].iloc[0]), list(region["boxes"].iloc[0])
        first = int(region["region"].iloc[0]) << SUB_BITS
        own = np.array([box["cell"] for box in found]) - first
        low, high = numbered_boxes(tree, own, [b["low"] for b in found], [b["high"] for b in found])
        x = np.stack(points["x"].to_numpy())
        place, cell = cells_within(x, points["limit"].to_numpy(), tree, low, high)
        other = cell + first != points["home"].to_numpy()[place]
        made = points[["query", "x"]].iloc[place[other]].reset_index(drop=True)
        return made.assign(cell=cell[other] + first)

    schema = "query long, x array<double>, cell long"
    return region_by_region(points, regions, number, block_rows, reach, schema)


class _KnnParams(Params):
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    weights = Param(Params._dummy(), "weights", "distance or uniform", TypeConverters.toString)
    cellRows = Param(Params._dummy(), "cellRows", "rows per cell", TypeConverters.toInt)
    blockRows = Param(Params._dummy(), "blockRows", "rows per block", TypeConverters.toInt)
    queryRows = Param(Params._dummy(), "queryRows", "queries per block", TypeConverters.toInt)
    regions = Param(Params._dummy(), "regions", "cells of the first level", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(
            k=8,
            weights="distance",
            cellRows=CELL_ROWS,
            blockRows=BLOCK_ROWS,
            queryRows=QUERY_ROWS,
            regions=REGIONS,
        )


class KnnRegressor(Estimator, _KnnParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(
        self,
        *,
        k=8,
        weights="distance",
        cellRows=CELL_ROWS,
        blockRows=BLOCK_ROWS,
        queryRows=QUERY_ROWS,
        regions=REGIONS,
    ):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "KnnModel":
        # Stored with a number per row, by which cells are cut into blocks.
        rows = settled(
            dataset.select(
                F.monotonically_increasing_id().alias("row"),
                vector_to_array("features").alias("x"),
                "label",
            )
        )
        total = rows.count()
        if total == 0:
            raise ValueError("no rows to learn from")
        share = min(1.0, SAMPLE_ROWS / total)
        # Only the cell borders come from the sample; every row is kept.
        taken = rows.select("x") if share == 1.0 else rows.select("x").sample(share, seed=7)
        sample = [r["x"] for r in taken.collect()] or [rows.first()["x"]]
        cell_rows = self.getOrDefault(self.cellRows)
        cells, regions = math.ceil(total / cell_rows), self.getOrDefault(self.regions)
        text = json.dumps(split_space(np.array(sample, dtype=float), min(regions, cells)))
        placed = rows.select("row", region_of(text)("x").alias("region"), "x", "label")
        trees = None
        if cells > regions:
            placed = settled(placed)
            sizes = settled(placed.groupBy("region").agg(F.count(F.lit(1)).alias("rows")))
            trees = settled(region_trees(placed, sizes, cell_rows))
        placed = settled(celled(placed, trees, "row", self.getOrDefault(self.blockRows)))
        width = range(len(sample[0]))
        boxes = settled(
            placed.groupBy("region", "cell").agg(
                F.count(F.lit(1)).alias("rows"),
                F.array(*[F.min(F.col("x")[j]) for j in width]).alias("low"),
                F.array(*[F.max(F.col("x")[j]) for j in width]).alias("high"),
            )
        )
        # One row for each region, of which there are a bounded number.
        around = (
            boxes.groupBy("region")
            .agg(
                F.array(*[F.min(F.col("low")[j]) for j in width]).alias("low"),
                F.array(*[F.max(F.col("high")[j]) for j in width]).alias("high"),
            )
            .orderBy("region")
            .collect()
        )
        bounds = {name: [r[name] for r in around] for name in ("region", "low", "high")}
        kept = {p.name: v for p, v in self.extractParamMap().items()}
        model = KnnModel(tree=text, boxes=json.dumps(bounds), cells=boxes.count())
        model._set(**kept)
        return model.holding(placed, boxes, trees)


class KnnModel(Model, _KnnParams, MLWritable, MLReadable):
    tree = Param(Params._dummy(), "tree", "borders of regions", TypeConverters.toString)
    boxes = Param(Params._dummy(), "boxes", "bounding boxes of regions", TypeConverters.toString)
    cells = Param(Params._dummy(), "cells", "cells of both levels", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, tree=None, boxes=None, cells=None):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self.rows: DataFrame | None = None
        self.bounds: DataFrame | None = None
        self.trees: DataFrame | None = None

    def holding(
        self, rows: DataFrame, bounds: DataFrame, trees: DataFrame | None
    ) -> "KnnModel":
        self.rows, self.bounds, self.trees = rows, bounds, trees
        return self

    def copy(self, extra=None) -> "KnnModel":
        return super().copy(extra).holding(self.rows, self.bounds, self.trees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # Stored, so that the numbers given to the queries stay theirs.
        queries = settled(dataset.withColumn("_query", F.monotonically_increasing_id()))
        predictions = self.predictions(
            queries.select(F.col("_query").alias("query"), vector_to_array("features").alias("x"))
        )
        return queries.join(
            predictions.withColumnRenamed("query", "_query"), "_query", "left"
        ).drop("_query")

    def predictions(self, queries: DataFrame) -> DataFrame:
        """``query`` and ``prediction`` for rows of ``query`` and ``x``."""
        k = self.getOrDefault(self.k)
        hits = self.hits(queries)
        return weighted_mean(nearest(hits, k), self.getOrDefault(self.weights))

    def hits(self, queries: DataFrame) -> DataFrame:
        k = self.getOrDefault(self.k)
        tree, boxes = self.getOrDefault(self.tree), self.getOrDefault(self.boxes)

        @F.pandas_udf("array<int>")
        def regions_within(x: pd.Series, reach: pd.Series) -> pd.Series:
            known, box = _geometry(tree), _geometry(boxes)
            low, high = numbered_boxes(known, box["region"], box["low"], box["high"])
            points, limits = np.stack(x.to_numpy()), reach.to_numpy()
            step = max(1, MATRIX_CELLS // len(low))
            out = []
            for start in range(0, len(points), step):
                some = slice(start, start + step)
                place, region = cells_within(points[some], limits[some], known, low, high)
                order = np.argsort(place, kind="stable")
                ends = np.searchsorted(place[order], np.arange(1, len(points[some])))
                out.extend(np.split(region[order].astype(np.int32), ends))
            return pd.Series(out)

        homed = queries.withColumn("region", region_of(tree)("x"))
        if self.trees is not None:
            homed = settled(homed)
        homed = celled(homed, self.trees, "query", self.getOrDefault(self.queryRows))
        homed = homed.select("query", "x", "cell")
        if self.trees is not None:
            homed = settled(homed)
        own = settled(nearest(self._search(homed), k).select("query", "distance", "label"))
        if self.getOrDefault(self.cells) == 1:
            return own
        reach = own.groupBy("query").agg(
            F.when(F.count(F.lit(1)) >= k, F.max("distance"))
            .otherwise(F.lit(float("inf")))
            .alias("reach")
        )
        # Rounding must not lose a cell that touches the limit.
        limit = F.coalesce("reach", F.lit(float("inf"))) * (1 + 1e-9)
        bounded = homed.join(reach, "query", "left").withColumn("limit", limit)
        near = bounded.select(
            "query", "x", F.col("cell").alias("home"), "limit",
            F.explode(regions_within("x", "limit")).alias("region"),
        )
        if self.trees is None:
            # Every region is one cell.
            cell = F.shiftleft(F.col("region").cast("long"), SUB_BITS).alias("cell")
            wider = near.select("query", "x", "home", cell).where(F.col("cell") != F.col("home"))
        else:
            rows = self.getOrDefault(self.queryRows)
            wider = reached(settled(near), self.trees, self.bounds, "query", rows)
        return own.unionByName(self._search(settled(wider.select("query", "x", "cell"))))

    def _search(self, asked: DataFrame) -> DataFrame:
        """Hits of the queries in the cells they name, block by block."""
        k = self.getOrDefault(self.k)
        counts = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("asked"))

        def cut(rows: str, size: int, name: str) -> Column:
            return F.ceil(F.col(rows) / size).cast("int").alias(name)

        blocks = settled(
            self.bounds.join(counts, "cell").select(
                "cell",
                cut("rows", self.getOrDefault(self.blockRows), "row_blocks"),
                cut("asked", self.getOrDefault(self.queryRows), "query_blocks"),
                "rows",
                "asked",
            )
        )
        met = F.col("rows") * F.col("query_blocks") + F.col("asked") * F.col("row_blocks")
        meetings = math.ceil((blocks.agg(F.sum(met)).first()[0] or 0) / MEETING_ROWS) or 1
        blocks = blocks.drop("rows", "asked")
        meeting = F.pmod(F.xxhash64(*BLOCK), F.lit(meetings)).alias("meeting")

        def every(count: str) -> Column:
            return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

        def spread(number: str, count: str) -> Column:
            return F.pmod(number, count).cast("int")

        rows = (
            self.rows.join(blocks, "cell")
            .withColumn("row_block", spread("row", "row_blocks"))
            .withColumn("query_block", every("query_blocks"))
        )
        queries = (
            asked.join(blocks, "cell")
            .withColumn("query_block", spread("query", "query_blocks"))
            .withColumn("row_block", every("row_blocks"))
        )

        def match(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return neighbours(left, right, k)

        return (
            queries.select(meeting, *BLOCK, "query", "x")
            .groupBy("meeting")
            .cogroup(rows.select(meeting, *BLOCK, "x", "label").groupBy("meeting"))
            .applyInPandas(match, "query long, distance double, label double")
        )

    def write(self) -> MLWriter:
        return _KnnWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _KnnReader()


class _KnnWriter(MLWriter):
    def __init__(self, instance: KnnModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        parts = {"rows": self.instance.rows, "bounds": self.instance.bounds}
        if self.instance.trees is not None:
            parts["trees"] = self.instance.trees
        for name, part in parts.items():
            part.write.mode("overwrite").parquet(f"{path}/{name}")


class _KnnReader(MLReader):
    def load(self, path: str) -> KnnModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = KnnModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        read = self.sparkSession.read
        trees = None
        if path_exists(self.sparkSession, f"{path}/trees"):
            trees = read.parquet(f"{path}/trees")
        return model.holding(read.parquet(f"{path}/rows"), read.parquet(f"{path}/bounds"), trees)
