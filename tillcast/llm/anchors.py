"""SimHash near duplicates by anchor-point covering.

1. One pass over the texts makes each a fingerprint of 64 bits. Equal fingerprints are one class, so
   copies are never compared with each other.
2. The anchors are the words of a covering code: the bits are cut into blocks, each with a perfect
   code, so every fingerprint has one nearest word in each block, its home, no farther than the
   block's covering radius. A fingerprint also visits every anchor that is farther than the covering
   radii by no more than the threshold in all. Of two fingerprints within the threshold, each visits
   the other's home, so comparing the homes of an anchor with its visitors finds every link, and
   taking only the smaller one's home finds it once. Bits outside the blocks aren't looked at until
   the comparison.
3. The code grows with the number of fingerprints (counted), so that anchors stay sparse. What is
   still crowded at one anchor, as edited copies of one text are, isn't compared there: these
   fingerprints go to all points of the space within half the threshold, the finest covering code of
   all, where any two that meet are linked, and one minimum per point links them all.
4. Components of the links name the groups.

A shingle is k words joined by spaces, as often as it occurs; a text of fewer words is one shingle.

Defined cases: a text with no words, or null, has fingerprint zero and is linked like any other; a
group's name is its smallest id (a group without any id has none); repeated rows are one class and
all come back; very long texts are hashed in slices of bounded size; an empty table gives an empty
result. Extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import small_enough
from tillcast.llm.components import components
from tillcast.session import settled

# Fixed value: the seed of the shingles' hashes.
SEED = 42
BITS = 64
LOW_BITS = np.uint64(0x0101010101010101)
SLICE = 1 << 20  # shingles hashed at once


@dataclass(frozen=True)
class PerfectCode:
    """A binary code whose balls of ``radius`` around its words fill the space without overlap.

    A cyclic code, given by its generator polynomial; ``length - degree`` bits are free.
    """

    length: int
    generator: int
    radius: int

    @property
    def degree(self) -> int:
        return self.generator.bit_length() - 1

    def syndrome(self, word: int) -> int:
        """The remainder by the generator; words of the code have none."""
        for bit in range(word.bit_length() - 1, self.degree - 1, -1):
            if word >> bit & 1:
                word ^= self.generator << (bit - self.degree)
        return word

    def by_syndrome(self, weight: int) -> dict[int, list[int]]:
        """All differences of exactly so many bits, by syndrome."""
        single = [self.syndrome(1 << bit) for bit in range(self.length)]
        found: dict[int, list[int]] = {}
        for bits in combinations(range(self.length), weight):
            key, word = 0, 0
            for bit in bits:
                key ^= single[bit]
                word |= 1 << bit
            found.setdefault(key, []).append(word)
        return found


# The perfect binary codes of Golay and Hamming, by their generator polynomials.
GOLAY = PerfectCode(23, 0b101011100011, 3)
HAMMING = PerfectCode(15, 0b10011, 1)
#: From few anchors to many: 2^12, 2^24 and 2^35.
CODES = ((GOLAY,), (GOLAY, GOLAY), (GOLAY, GOLAY, HAMMING))


@dataclass(frozen=True)
class Covering:
    """Words in a shingle, bits that may differ, and how many comparisons an anchor may hold."""

    words: int = 3
    threshold: int = 2
    crowded: int = 1 << 20
    in_task: int = 1 << 14  # fingerprints whose visits one task makes

    def code(self, fingerprints: int) -> Sequence[PerfectCode]:
        """The first with as many anchors as fingerprints; the largest, if none has."""
        for blocks in CODES:
            if 2 ** sum(b.length - b.degree for b in blocks) >= fingerprints:
                return blocks
        return CODES[-1]


def bit_majorities(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For consecutive runs of ``counts`` hashes: the bits set in over half of a run.

    Eight bits are added up at once, each in a byte of its own, which holds for 255 hashes.
    """
    made = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return made
    sizes = counts[full]
    parts = -(-sizes // 255)
    first = np.cumsum(parts) - parts
    within = np.arange(parts.sum()) - np.repeat(first, parts)
    starts = np.repeat(np.cumsum(sizes) - sizes, parts) + 255 * within
    for shift in range(8):
        lanes = hashes >> np.uint64(shift) & LOW_BITS
        sums = np.add.reduceat(lanes, starts).view(np.uint8).reshape(-1, 8)
        set_bits = 2 * np.add.reduceat(sums.astype(np.int64), first) > sizes[:, None]
        lane = set_bits.astype(np.uint8).reshape(-1).view(np.uint64)
        made[full] |= lane << np.uint64(shift)
    return made


def shingle_hashes(text: bytes, k: int) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles, in slices."""
    words = text.lower().split()  # for bytes both look at ASCII only
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(k, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), SLICE):
        spans = zip(starts[at : at + SLICE].tolist(), ends[at : at + SLICE].tolist())
        size = min(SLICE, len(starts) - at)
        yield np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, size)


def fingerprint(slices: list[np.ndarray]) -> int:
    """Of one text in several slices, by the counts of every bit."""
    counts, total = np.zeros(BITS, np.int64), 0
    for hashes in slices:
        shifts = np.arange(BITS, dtype=np.uint64)
        counts += [int((hashes >> s & np.uint64(1)).sum()) for s in shifts]
        total += len(hashes)
    return sum(1 << bit for bit in range(BITS) if 2 * counts[bit] > total)


def _fingerprinter(words: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            made = np.zeros(len(texts), np.uint64)
            rows, waiting, held = [], [], 0

            def flush():
                if rows:
                    counts = np.array([len(h) for h in waiting])
                    made[rows] = bit_majorities(np.concatenate(waiting), counts)
                    rows.clear()
                    waiting.clear()

            for row, text in enumerate(texts):
                slices = list(shingle_hashes(text.as_py(), words))
                if len(slices) > 1:
                    made[row] = fingerprint(slices)
                elif slices:
                    rows.append(row)
                    waiting += slices
                    held += len(slices[0])
                if held > SLICE:
                    flush()
                    held = 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made.view(np.int64))], names=["id", "fingerprint"]
            )

    return make


def fingerprints(docs: DataFrame, words: int = 3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint) of every row; the fingerprint's 64 bits as a long."""
    texts = docs.select(
        F.col(id).cast("long").alias("id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    return texts.mapInArrow(_fingerprinter(words), "id long, fingerprint long")


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


class Visits:
    """The anchors of fingerprints, by tables over the syndromes of each block."""

    def __init__(self, blocks: Sequence[PerfectCode], threshold: int):
        self.blocks, self.threshold = blocks, threshold
        self.tables = [
            [self._differences(block, excess) for excess in range(threshold + 1)]
            for block in blocks
        ]

    @staticmethod
    def _differences(block: PerfectCode, excess: int) -> tuple[np.ndarray, np.ndarray]:
        """From a syndrome to the words that are farther than the radius by ``excess``.

        Differences to them, all in a row, and where each syndrome's begin. Without excess there is
        one for each syndrome, as the balls of the radius fill the space.
        """
        found: dict[int, list[int]] = {}
        for weight in range(block.radius + 1) if excess == 0 else [block.radius + excess]:
            for key, words in block.by_syndrome(weight).items():
                found.setdefault(key, []).extend(words)
        lists = [found.get(key, []) for key in range(1 << block.degree)]
        offsets = np.cumsum([0, *map(len, lists)])
        return offsets, np.array([word for words in lists for word in words], np.uint64)

    def anchors(
        self, given: np.ndarray, excess: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, anchors) up to ``excess`` beyond the radii, one combination of blocks at a time."""
        syndromes, kept, shift = [], np.uint64(0), 0
        for block in self.blocks:
            made = np.zeros(len(given), np.int64)
            for bit in range(block.length):
                is_set = given >> np.uint64(shift + bit) & np.uint64(1)
                made ^= np.where(is_set, block.syndrome(1 << bit), 0)
            syndromes.append(made)
            kept |= np.uint64(((1 << block.length) - 1) << shift)
            shift += block.length
        for excesses in product(range(excess + 1), repeat=len(self.blocks)):
            if sum(excesses) > excess:
                continue
            rows, anchors, shift = np.arange(len(given)), given & kept, 0
            for block, table, syndrome, e in zip(self.blocks, self.tables, syndromes, excesses):
                offsets, words = table[e]
                begin = offsets[syndrome[rows]]
                n = offsets[syndrome[rows] + 1] - begin
                places = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
                anchors = np.repeat(anchors, n) ^ (words[places] << np.uint64(shift))
                rows = np.repeat(rows, n)
                shift += block.length
            yield rows, anchors


AT = "anchor long, fingerprint long"


def _visitor(blocks: Sequence[PerfectCode], threshold: int, excess: int):
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        visits = Visits(blocks, threshold)
        for batch in batches:
            given = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for rows, anchors in visits.anchors(given, excess):
                columns = [pa.array(anchors.view(np.int64)), pa.array(given[rows].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "fingerprint"])

    return visit


def _points(threshold: int):
    """Every point within half the threshold of a fingerprint; all of the space is the code."""
    reach = threshold // 2

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = [sum(1 << b for b in bits) for w in range(reach + 1) for bits in combinations(range(BITS), w)]
        flips = np.array(flips, np.uint64)
        for batch in batches:
            given = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            points = (given[:, None] ^ flips[None, :]).reshape(-1)
            own = np.repeat(given, len(flips))
            columns = [pa.array(points.view(np.int64)), pa.array(own.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "fingerprint"])

    return meet


def links(classes: DataFrame, count: int, method: Covering) -> DataFrame:
    """(a, b): fingerprints within the threshold, enough to have the components of all of them.

    ``classes`` has one column, distinct fingerprints; ``count`` is their number.
    """
    blocks, threshold = method.code(count), method.threshold
    # Each makes dozens of visits, so few go to one task.
    dealt = classes.repartition(-(-count // method.in_task) or 1, "fingerprint")
    homes = settled(dealt.mapInArrow(_visitor(blocks, threshold, 0), AT))
    lived = settled(homes.groupBy("anchor").agg(F.count("*").alias("homes")))
    visits = dealt.mapInArrow(_visitor(blocks, threshold, threshold), AT)
    visits = settled(visits.join(small_enough(lived, 64), "anchor"))
    met = visits.groupBy("anchor", "homes").agg(F.count("*").alias("visitors"))
    met = met.where("visitors > 1").withColumn(
        "crowded", F.col("visitors") * F.col("homes") > method.crowded
    )
    met = settled(met.select("anchor", "crowded"))
    calm = small_enough(met.where("not crowded").select("anchor"), 64)
    a = homes.join(calm, "anchor").select("anchor", F.col("fingerprint").alias("a"))
    b = visits.join(calm, "anchor").select("anchor", F.col("fingerprint").alias("b"))
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    near = (F.col("a") < F.col("b")) & (differing <= threshold)
    near = a.join(b, (a["anchor"] == b["anchor"]) & near).select("a", "b")
    if met.where("crowded").isEmpty():
        return near
    full = small_enough(met.where("crowded").select("anchor"), 64)
    crowd = visits.join(full, "anchor").select("fingerprint").distinct()
    points = settled(crowd.mapInArrow(_points(threshold), AT))
    hubs = points.groupBy("anchor").agg(
        F.min("fingerprint").alias("a"), F.max("fingerprint").alias("most")
    )
    through = points.join(hubs.where("a < most"), "anchor").where("fingerprint <> a")
    return near.unionByName(through.select("a", F.col("fingerprint").alias("b")).distinct())


def groups(
    docs: DataFrame, method: Covering = Covering(), id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, fingerprint, component_id) for every row; the fingerprint as a long."""
    if method.threshold % 2:
        raise ValueError("the threshold must be even, as crowds meet half way")
    signed = settled(fingerprints(docs, method.words, id, text))
    classes = settled(signed.groupBy("fingerprint").agg(F.min("id").alias("least")))
    linked = links(classes.select("fingerprint"), classes.count(), method)
    root = components(settled(linked)).withColumnRenamed("node", "fingerprint")
    named = classes.join(root, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = small_enough(settled(named.join(names, "root").select("fingerprint", "component_id")), 64)
    return signed.join(named, "fingerprint").select(
        F.col("id").alias(id), "fingerprint", "component_id"
    )
