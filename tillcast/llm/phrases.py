"""Collocations: phrases that occur more often than their parts explain, counted by prefix-free parsing.

1. Texts are cut into pieces at punctuation and parsed into overlapping chunks: a chunk begins at the
   start of a piece and wherever the words of a window of ``longest - 1`` trigger (their hash says so,
   so equal passages are cut alike wherever they stand), and ends with the window of the next. Distinct
   chunks of a language form the dictionary, with how often the parse uses them. A chunk owns the
   starts before its last window, a piece's last chunk owns all of its own, so each phrase of at most
   ``longest`` words lies inside the one chunk that owns its start, and overlaps are assigned once.
2. Phrases are counted inside distinct chunks, weighted, from one word upwards. A phrase is counted
   only if the phrases of one word less at its start and end may be frequent, which a bit map of
   bounded size tells by their hashes: it says yes too often the fuller it is, never no to a frequent
   one. Hashed counts therefore only choose what may be frequent; the last pass counts those as
   words, and what falls below the limit is dropped.
3. Scores, redundancy and ranking are joins and aggregates of the frequent phrases. Decimal numbers of
   38 digits hold the products.

Frequent words are the only ones that many rows share, and they are added up in the tasks first.

Defined cases: a null text is empty; a null language is ``und``; empty pieces have no words; repeated
rows count again; a text of any length is cut into its pieces; equal scores and counts are ranked by
the phrase's bytes; an empty table gives an empty result. Extra columns aren't read. Two phrases
whose 64-bit hashes agree could be added up as one in a task of the last pass: with a million
frequent phrases in a task the chance is below 1e-7.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import small_enough
from tillcast.llm.shingles import GOLDEN, mixed
from tillcast.session import settled

# What parts pieces, what parts words, and the name of an unknown language.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"
UNKNOWN = "und"
FOLDED = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + BREAKS + BLANKS,
    b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(BREAKS) + b" " * len(BLANKS),
)


@dataclass(frozen=True)
class Mining:
    """Words in a phrase, the least count, redundancy in per cent, phrases wanted of a language."""

    longest: int = 5
    least: int = 100
    contained: int = 100
    wanted: int = 2000
    every: int = 16  # words between triggers, on average
    map_bits: int = 1 << 26  # of a bit map, 8 MB
    held: int = 1 << 20  # phrases added up in a task before they are sent


#: Odd, and scattered values of bytes; blanks and breaks have none, so they don't change a sum.
BASE = np.uint64(0x9E3779B97F4A7C13)
VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
VALUES[[0x20, 0x0A]] = 0
TEXT_BYTES = 4 << 20  # of texts that are parsed at once
WORDS_AT_ONCE = 1 << 18


def word_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each word of a buffer by its bytes; a word ends where blanks or the next one begin."""
    made = np.empty(len(starts), np.uint64)
    bounds = np.append(starts, len(data))
    for at in range(0, len(starts), WORDS_AT_ONCE):
        here = bounds[at : at + WORDS_AT_ONCE + 1]
        sizes = np.diff(here)
        powers = np.full(int(sizes.max()), BASE)
        powers = np.multiply.accumulate(powers)
        place = np.arange(here[0], here[-1]) - np.repeat(here[:-1], sizes)
        terms = VALUES[data[here[0] : here[-1]]] * powers[place]
        made[at : at + WORDS_AT_ONCE] = np.add.reduceat(terms, here[:-1] - here[0])
    return mixed(made)


def rolled(words: np.ndarray, length: int, seed: np.ndarray | None = None) -> np.ndarray:
    """The hash of the ``length`` words from each place on."""
    made = np.zeros(max(len(words) - length + 1, 0), np.uint64)
    if seed is not None:
        made = seed[: len(made)]
    for i in range(length):
        made = mixed(made + GOLDEN + words[i : i + len(made)])
    return made


def chunks_of(texts: list[bytes], method: Mining) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """For every chunk of the texts: the text's number, the words joined by blanks, the starts it owns."""
    overlap = method.longest - 1
    data = np.frombuffer(b"\n".join(texts).translate(FOLDED), np.uint8)
    inside = np.concatenate([[False], (data != 0x20) & (data != 0x0A), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    n = len(starts)
    if not n:
        return np.empty(0, np.int64), [], np.empty(0, np.int64)
    piece = np.searchsorted(np.flatnonzero(data == 0x0A), starts)
    is_first = np.concatenate([[True], piece[1:] != piece[:-1]])
    first = np.flatnonzero(is_first)
    piece_end = np.append(first[1:], n)
    piece_end = np.repeat(piece_end, np.diff(np.append(first, n)))
    triggers = np.flatnonzero(rolled(word_hashes(data, starts), overlap) % np.uint64(method.every) == 0)
    triggers = triggers[triggers + overlap <= piece_end[triggers]]
    is_first[triggers] = True
    begins = np.flatnonzero(is_first)
    following, last = np.append(begins[1:], n), piece_end[begins]
    ends_piece = following >= last
    stops = np.where(ends_piece, last, following + overlap)
    owned = np.where(ends_piece, last, following) - begins
    # The words with one blank between any two.
    sizes = ends - starts
    ends_joined = np.cumsum(sizes + 1) - 1
    kept = inside[1:-1].copy()
    kept[ends[ends < len(data)]] = True
    joined = data[kept]
    joined = np.where(joined == 0x0A, np.uint8(0x20), joined).tobytes()
    spans = zip((ends_joined - sizes)[begins].tolist(), ends_joined[stops - 1].tolist())
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    rows = np.searchsorted(offsets, starts[begins], "right") - 1
    return rows, [joined[a:b] for a, b in spans], owned


def _parser(method: Mining):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).cast(pa.large_binary())
            sizes = np.cumsum(pc.binary_length(sizes).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                # At least one text, and no more than fit.
                before = sizes[at - 1] if at else 0
                upto = max(int(np.searchsorted(sizes, before + TEXT_BYTES, "right")), at + 1)
                rows, chunks, owned = chunks_of(batch.column(1)[at:upto].to_pylist(), method)
                langs = batch.column(0).take(pa.array(rows + at))
                columns = [langs, pa.array(chunks, pa.binary()), pa.array(owned, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "chunk", "owned"])
                at = upto

    return parse


def parsed(docs: DataFrame, method: Mining, lang: str = "lang", text: str = "text") -> DataFrame:
    """The dictionary: (lang, chunk, owned, weight) of each distinct chunk."""
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    chunks = texts.mapInArrow(_parser(method), "lang string, chunk binary, owned long")
    return chunks.groupBy("lang", "chunk", "owned").agg(F.count("*").alias("weight"))


class Grams:
    """The phrases that a batch of chunks owns the starts of, by the hashes of their words."""

    def __init__(self, batch: pa.RecordBatch):
        chunks = batch.column(1).cast(pa.binary())
        _, offsets, data = chunks.buffers()
        offsets = np.frombuffer(offsets, np.int32)[chunks.offset :][: len(chunks) + 1]
        self.bytes = memoryview(data)[offsets[0] : offsets[-1]]
        found = np.frombuffer(self.bytes, np.uint8)
        offsets = (offsets - offsets[0]).astype(np.int64)
        blanks = np.flatnonzero(found == 0x20)
        is_start = np.zeros(len(found) + 1, bool)
        is_start[blanks + 1] = True
        is_start[offsets] = True
        self.starts_at = np.flatnonzero(is_start)[:-1]
        is_end = np.zeros(len(found) + 1, bool)
        is_end[blanks] = True
        is_end[offsets[1:]] = True
        self.ends_at = np.flatnonzero(is_end)
        first = np.searchsorted(self.starts_at, offsets)
        sizes = np.diff(first)
        numbers = np.arange(len(self.starts_at))
        self.chunk = np.repeat(np.arange(len(sizes)), sizes)
        place = numbers - first[self.chunk]
        owned = batch.column(2).to_numpy(zero_copy_only=False)
        self.own = place < owned[self.chunk]
        self.room = first[self.chunk + 1] - numbers
        self.weight = batch.column(3).to_numpy(zero_copy_only=False)[self.chunk]
        self.langs = batch.column(0)
        named = self.langs.dictionary_encode()
        seeds = [xxhash.xxh3_64_intdigest(name) for name in named.dictionary.to_pylist()]
        of_chunk = np.array(seeds, np.uint64)[named.indices.to_numpy(zero_copy_only=False)]
        self.seed = of_chunk[self.chunk]
        self.hashed = word_hashes(found, self.starts_at)

    def of(self, length: int) -> np.ndarray:
        """The hash of the phrase from every place on, also where it runs out of its chunk."""
        return rolled(self.hashed, length, self.seed)

    def starts(self, length: int) -> np.ndarray:
        """The places that own a phrase of this length."""
        return np.flatnonzero(self.own & (self.room >= length))

    def phrase(self, place: int, length: int) -> bytes:
        return bytes(self.bytes[self.starts_at[place] : self.ends_at[place + length - 1]])


def is_marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes % np.uint64(64 * len(bits))
    return bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1) > 0


def added_up(hashes: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, the sums of their weights, and where each stood first."""
    found, weight = np.concatenate(hashes), np.concatenate(weights)
    order = np.argsort(found, kind="stable")
    found = found[order]
    begin = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else order
    sums = np.add.reduceat(weight[order], begin) if len(begin) else weight
    return found[begin], sums, order[begin]


def _counter(length: int, shorter: Broadcast | None, method: Mining):
    """Sums of the phrases of one length whose shorter ones may be frequent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, weights, held = [], [], 0

        def sums() -> pa.RecordBatch:
            distinct, total, _ = added_up(found, weights)
            found.clear()
            weights.clear()
            columns = [pa.array(distinct.view(np.int64)), pa.array(total)]
            return pa.RecordBatch.from_arrays(columns, names=["phrase", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            grams = Grams(batch)
            at = grams.starts(length)
            if shorter is not None:
                may = is_marked(shorter.value, grams.of(length - 1))
                at = at[may[at] & may[at + 1]]
            found.append(grams.of(length)[at])
            weights.append(grams.weight[at])
            held += len(at)
            if held >= method.held:
                yield sums()
                held = 0
        if found:
            yield sums()

    return count


def _marked(frequent: DataFrame, method: Mining) -> Broadcast:
    """A bit map of the frequent hashes; the driver gets its words that aren't zero, at most 2^20."""
    at = F.pmod(F.col("phrase"), F.lit(method.map_bits))  # as a power of two, the same unsigned
    bit = F.expr(f"shiftleft(1L, cast(pmod(phrase, 64) as int))")
    words = frequent.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(method.map_bits // 64, np.uint64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(bits)


RESOLVED = "lang string, words int, phrase binary, n long"


def _resolver(maps: list[Broadcast], method: Mining):
    """Phrases in words, with sums over what a task has gathered."""

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, held = [], 0

        def told() -> Iterator[pa.RecordBatch]:
            starts = np.cumsum([0, *(len(g.hashed) for g in gathered)])
            for length in range(1, len(maps) + 1):
                found, weights, places = [], [], []
                for grams, start in zip(gathered, starts):
                    at = grams.starts(length)
                    made = grams.of(length)[at]
                    may = is_marked(maps[length - 1].value, made)
                    found.append(made[may])
                    weights.append(grams.weight[at[may]])
                    places.append(start + at[may])
                _, sums, first = added_up(found, weights)
                langs, phrases = [], []
                place = np.concatenate(places)[first]
                of = np.searchsorted(starts, place, "right") - 1
                for i, at in zip(of.tolist(), (place - starts[of]).tolist()):
                    phrases.append(gathered[i].phrase(at, length))
                    langs.append(gathered[i].langs[int(gathered[i].chunk[at])].as_py())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(langs, pa.string()),
                        pa.array(np.full(len(phrases), length, np.int32)),
                        pa.array(phrases, pa.binary()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["lang", "words", "phrase", "n"],
                )

        for batch in batches:
            if not batch.num_rows:
                continue
            gathered.append(Grams(batch))
            held += len(gathered[-1].hashed)
            if held >= method.held // 4:
                yield from told()
                gathered.clear()
                held = 0
        if gathered:
            yield from told()

    return resolve


def frequent_phrases(chunks: DataFrame, method: Mining) -> DataFrame:
    """(lang, words, phrase, f) of all phrases of a stored dictionary that occur often enough."""
    maps: list[Broadcast] = []
    for length in range(1, method.longest + 1):
        counted = chunks.mapInArrow(
            _counter(length, maps[-1] if maps else None, method), "phrase long, n long"
        )
        often = counted.groupBy("phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= method.least)
        maps.append(_marked(often, method))
    told = chunks.mapInArrow(_resolver(maps, method), RESOLVED)
    summed = told.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))
    return summed.where(F.col("f") >= method.least).withColumn("phrase", F.col("phrase").cast("string"))


def scored(frequent: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, words, phrase, a, n, score, k, l, r): every candidate by its lowest-scoring cut."""
    parts = small_enough(frequent.select("lang", F.col("phrase").alias("part"), F.col("f").alias("times")), 256)
    cuts = (
        frequent.where("words > 1")
        .join(small_enough(sizes, 64), "lang")
        .select("lang", "words", "phrase", F.col("f").alias("a"), "n", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
        .withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    )
    left = parts.select("lang", F.col("part").alias("first"), F.col("times").alias("l"))
    right = parts.select("lang", F.col("part").alias("rest"), F.col("times").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr("(cast(1000 as decimal(38,0)) * a * n) div (cast(l as decimal(38,0)) * r)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    made = both.groupBy("lang", "words", "phrase", "a", "n").agg(lowest.alias("cut"))
    return made.select("lang", "words", "phrase", "a", "n", "cut.*")


def without_contained(candidates: DataFrame, method: Mining) -> DataFrame:
    """Candidates but those that stand inside a longer one which is as frequent."""
    words = F.split("phrase", " ")
    spans = F.explode(
        F.expr("flatten(transform(sequence(2, words - 1), s -> transform(sequence(1, words - s + 1), i -> struct(i, s))))")
    )
    inside = (
        candidates.where("words > 2")
        .select("lang", "a", words.alias("w"), spans.alias("span"))
        .select("lang", "a", F.array_join(F.slice("w", F.col("span.i"), F.col("span.s")), " ").alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    covered = 100 * F.col("longer") >= method.contained * F.col("a")
    return candidates.join(inside, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False))).drop("longer")


def collocations(
    docs: DataFrame, method: Mining = Mining(), lang: str = "lang", text: str = "text"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first phrases of each language."""
    chunks = settled(parsed(docs, method, lang, text))
    sizes = settled(chunks.groupBy("lang").agg(F.sum(F.col("owned") * F.col("weight")).alias("n")))
    frequent = settled(frequent_phrases(chunks, method))
    kept = without_contained(settled(scored(frequent, sizes)), method)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = kept.withColumn("rank", place.cast("long")).where(F.col("rank") <= method.wanted)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
