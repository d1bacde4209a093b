"""Near duplicates by SuperMinHash: signatures, banding, verification on full sets, grouping.

1. One pass over the texts gives each its number of shingles, a digest of its set, its band keys
   and a sketch of its signature. Texts with equal sets form a class, and only classes go on.
2. In every bucket (equal band key) each class is compared with two members only, the class with
   most copies, or smallest id, which edited copies are nearest to, and one drawn by hash, which
   differs from bucket to bucket: twice as many pairs as members. Verified links are contracted to
   components.
3. Buckets that still hold several components are searched once more across components, exactly:
   a class's shingles are put in order, rarest first, and two linked classes must share one among
   the first of each, early enough for the rest to suffice. In a large group of edited copies those
   are the edits, which few copies share, so no more pairs are made than are nearly linked. The
   pairs are verified, and the components of all links are the groups.

The banding overlooks a pair at the limit with chance 1e-6, the sketch that spares comparisons in
step 2 (five deviations below the limit) with less; step 3 has no such chance of its own.

Defined cases: a text with no words, or null, has no shingles and is linked with nothing; one with
fewer words than a shingle is one shingle; repeated rows fall into one class; a group's name is the
smallest id in it (nulls aside), and of rows without an id each forms a class by its text. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import floor, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm import shingles as sh
from tillcast.llm.common import small_enough, unused
from tillcast.llm.components import components
from tillcast.session import released, settled


@dataclass(frozen=True)
class NearDup:
    """Words in a shingle, the least similarity of a link in per cent, and how sure the banding is."""

    words: int = 5
    percent: int = 80
    miss: float = 1e-6
    slots: int = 128

    @property
    def banding(self) -> sh.Banding:
        return sh.Banding.tuned(self.percent / 100, self.miss, self.slots)

    @property
    def least_agreeing(self) -> int:
        """Slots of the sketch that a linked pair agrees in at least, five deviations down."""
        m, s = self.banding.slots, self.percent / 100
        return floor(m * (s - 5 * sqrt(s * (1 - s) / m)))


SetsOf = Callable[[DataFrame], DataFrame]

SIGNED = (
    "id long, handle long, size long, digest binary, bands array<long>, sketch array<long>"
)
SETS = "digest binary, shingles array<long>"


def _signer(method: NearDup):
    banding = method.banding

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = sh.WordHashes()
        for batch in batches:
            texts = [sh.words_of(t) for t in batch.column(2).to_pylist()]
            sets = sh.shingled(texts, method.words, hashes)
            signature = sh.superminhash(sets, banding.slots)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([sh.digest(s) for s in sets], pa.binary()),
                    as_lists(sh.band_keys(signature, banding)),
                    as_lists(sh.sketches(signature)),
                ],
                names=["id", "handle", "size", "digest", "bands", "sketch"],
            )

    return sign


def as_lists(table: np.ndarray) -> pa.Array:
    """A two-dimensional table as an array of lists."""
    offsets = np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.reshape(-1)))


def _set_maker(method: NearDup):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = sh.WordHashes()
        for batch in batches:
            texts = [sh.words_of(t) for t in batch.column(0).to_pylist()]
            sets = sh.shingled(texts, method.words, hashes)
            yield set_batch(sets)

    return make


def set_batch(sets: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
    shingles = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([sh.digest(s) for s in sets], pa.binary()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(shingles)),
        ],
        names=["digest", "shingles"],
    )


def _texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, handle, text): the handle tells rows of one id apart by their texts."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.col(id).cast("long").alias("id"),
        F.xxhash64(content).alias("handle"),
        content.cast("binary").alias("text"),
    )


def _grouped(texts: DataFrame, method: NearDup) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and (digest, root, component_id) of each class."""
    signed = settled(texts.mapInArrow(_signer(method), SIGNED))
    classes = settled(
        signed.where("size > 0")
        .groupBy("digest")
        .agg(
            F.min("id").alias("least"),
            F.count("*").alias("copies"),
            F.first("size").alias("size"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        )
        .withColumn("class", F.monotonically_increasing_id())
    )
    root = components(
        links_between(classes, lambda wanted: _sets(texts, classes, wanted, method), method)
    )
    named = (
        classes.select("digest", "class", "least")
        .join(root.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return signed, settled(named.join(names, "root").select("digest", "root", "component_id"))


def groups(docs: DataFrame, method: NearDup, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row; of each group the smallest id is kept."""
    signed, named = _grouped(_texts(docs, id, text), method)
    found = signed.select("id", "size", F.when(F.col("size") > 0, F.col("digest")).alias("digest"))
    return found.join(named, "digest", "left").select(
        F.col("id").alias(id),
        F.col("size").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"),
    )


def representatives(
    docs: DataFrame, method: NearDup, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each group, the one of the smallest id, and every row without words.

    Rows without an id come last in their group; rows equal in id and text are one document.
    """
    signed, named = _grouped(_texts(docs, id, text), method)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "handle")).alias("row")
    chosen = signed.join(named, "digest").groupBy("root").agg(first).select("row.id", "row.handle")
    chosen = chosen.unionByName(signed.where("size = 0").select("id", "handle")).distinct()
    chosen = chosen.select(F.col("id").alias("kept__id"), F.col("handle").alias("kept__handle"))
    chosen = small_enough(settled(chosen), 64)
    handle = unused(docs.columns, "handle")
    found = docs.withColumn(handle, F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    same = found[id].cast("long").eqNullSafe(chosen["kept__id"]) & (
        found[handle] == chosen["kept__handle"]
    )
    return found.join(chosen, same, "left_semi").dropDuplicates([id, handle]).drop(handle)


def links_between(classes: DataFrame, sets_of: SetsOf, method: NearDup) -> DataFrame:
    """(a, b) of linked classes, enough of them to have the components of all links.

    ``classes`` has class, copies, least, size, bands and sketch; ``sets_of`` gives (class, shingles) of the classes in
    a table of one column.
    """
    posted = classes.select("class", F.explode("bands").alias("key"), _prior().alias("prior"))
    pivots = (
        posted.groupBy("key")
        .agg(
            F.min_by("class", "prior").alias("first"),
            F.min_by("class", F.xxhash64("class", "key")).alias("drawn"),
            F.count("*").alias("n"),
        )
        .where("n > 1")
        .select("key", F.explode(F.array_distinct(F.array("first", "drawn"))).alias("pivot"))
    )
    posted = posted.drop("prior")
    star = (
        posted.join(pivots, "key")
        .where("class <> pivot")
        .select(F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b"))
    )
    facts = classes.select("class", "size", "sketch")
    star = settled(
        star.distinct()
        .join(_named(facts, "a"), "a")
        .join(_named(facts, "b"), "b")
        .where(_sizes_allow(method) & _sketches_allow(method))
        .select("a", "b")
    )
    sets = settled(sets_of(star.select("a").union(star.select("b"))))
    near = settled(_verified(star, sets, method))
    released(sets)
    rest = _rest(posted, components(near), sets_of, method)
    return near.unionByName(rest)


def _prior() -> Column:
    """Smallest for the class with most copies, then for the smallest id, as one number."""
    copies = F.least("copies", F.lit(1 << 20))
    id = F.coalesce(F.pmod("least", F.lit(1 << 40)), F.lit((1 << 40) - 1))
    return (F.lit(1 << 20) - copies) * (1 << 40) + id


def _rest(posted: DataFrame, root: DataFrame, sets_of: SetsOf, method: NearDup) -> DataFrame:
    """Links between different components of ``root`` that share a bucket."""
    rooted = posted.join(root.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "root", F.coalesce("root", "class")
    )
    mixed = (
        rooted.groupBy("key")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low <> high")
        .select("key")
    )
    open_classes = settled(rooted.join(mixed, "key").select("class", "root").distinct())
    sets = settled(sets_of(open_classes.select("class")))
    each = sets.join(open_classes, "class").select(
        "class", "root", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle")
    )
    counts = each.groupBy("shingle").agg(
        F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    rarest_first = Window.partitionBy("class").orderBy("n", "shingle")
    # With a similarity of p per cent, size - ceil(p size / 100) shingles may be missing.
    spare = F.col("size") - F.ceil(method.percent * F.col("size") / 100)
    early = (
        each.join(counts, "shingle")
        .withColumn("place", F.row_number().over(rarest_first))
        .where((F.col("place") <= spare + 1) & (F.col("low") != F.col("high")))
        .select("shingle", *EARLY)
    )
    early = settled(early)
    a = early.select("shingle", *[F.col(c).alias(f"a_{c}") for c in EARLY])
    b = early.select("shingle", *[F.col(c).alias(f"b_{c}") for c in EARLY])
    other = (F.col("a_class") < F.col("b_class")) & (F.col("a_root") != F.col("b_root"))
    left = F.least(F.col("a_size") - F.col("a_place"), F.col("b_size") - F.col("b_place"))
    enough = (1 + left) * (100 + method.percent) >= method.percent * (
        F.col("a_size") + F.col("b_size")
    )
    same = a["shingle"] == b["shingle"]
    pairs = a.join(b, same & other & _sizes_allow(method) & enough)
    pairs = settled(pairs.select(F.col("a_class").alias("a"), F.col("b_class").alias("b")).distinct())
    found = settled(_verified(pairs, sets, method))
    released(sets)
    return found


EARLY = ("class", "root", "size", "place")


def _named(facts: DataFrame, side: str) -> DataFrame:
    return facts.select(
        F.col("class").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("size", "sketch")]
    )


def _sizes_allow(method: NearDup) -> Column:
    return 100 * F.least("a_size", "b_size") >= method.percent * F.greatest("a_size", "b_size")


def _sketches_allow(method: NearDup) -> Column:
    """Whether enough slots agree: bytes that differ are folded to one bit each and counted."""
    slots, differing = method.banding.slots, F.lit(0)
    for i in range((slots + 7) // 8):
        x = F.col("a_sketch")[i].bitwiseXOR(F.col("b_sketch")[i])
        for shift in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    return differing <= slots - method.least_agreeing


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, method: NearDup) -> DataFrame:
    """(class, shingles) of the wanted classes (one column), made anew from the texts.

    Texts are moved only if the wanted ids are too many to be broadcast.
    """
    wanted = wanted.toDF("class").distinct()
    sought = settled(classes.select("class", "digest", "least").join(wanted, "class"))
    ids = small_enough(sought.select(F.col("least").alias("sought")), 64)
    texts = docs.join(ids, docs["id"].eqNullSafe(ids["sought"]), "left_semi").select("text")
    made = texts.mapInArrow(_set_maker(method), SETS)
    keys = small_enough(sought.select("digest", "class"), 128)
    return made.join(keys, "digest").select("class", "shingles").dropDuplicates(["class"])


def _verified(pairs: DataFrame, sets: DataFrame, method: NearDup) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a = sets.select(F.col("class").alias("a"), F.col("shingles").alias("a_set"))
    b = sets.select(F.col("class").alias("b"), F.col("shingles").alias("b_set"))
    common = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - common
    linked = 100 * common >= method.percent * union
    return pairs.join(b, "b").join(a, "a").where(linked).select("a", "b")
