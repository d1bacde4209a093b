"""Packing by powers of two.

Each document's ids, closed by one end id, are cut into as many pieces of the full length as fit
and one piece for every binary digit of what is left. A piece is a sequence of its own, of a length
that is a power of two, so nothing is padded and no sequence crosses documents; sequences of equal
length form a bucket. One narrow pass, no shuffle: a document's pieces depend on it alone.

The tokenizer drops white space and never joins across it, so a text's ids are those of its words. A
few megabytes of texts at a time are cut into words as arrays, their distinct words are encoded in long
strings, parted by one of the tokenizer's own special tokens, and ids are gathered by the words' numbers,
so no step is taken word by word. A worker remembers the ids of up to 800,000 words in arrays of some
35 bytes a word, 28 MB, under a digest of 128 bits.
ASCII letters are put in lower case first, as the tokenizer does; a word with ``<|`` in it, which may hold
a special token, stays as it is and is encoded by itself.

Defined cases: a null or empty text is the end id alone; a document without an id keeps a null id;
repeated rows are packed one by one; a text of any length is cut like the others, but its own bytes and
ids are held at once; an empty table gives an empty result. Extra columns aren't read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

TEXT_BYTES = 4 << 20  # of texts that are encoded at once
STRING_WORDS = 2000  # distinct words in one string
REMEMBERED = 800_000  # words
SPECIAL = b"<|"
PIECES = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"
)


@dataclass(frozen=True)
class Packing:
    """The tokenizer's file, read on the driver; the id that ends documents; the longest sequence;
    a special token to part words by."""

    tokenizer: str
    end: int = 1
    longest: int = 2048  # a power of two
    parting: str = "<|endoftext|>"


def distinct_words(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts, each as the number of a distinct word, and how many each text has."""
    joined = b"\n".join(texts)
    data = np.frombuffer(joined.lower(), np.uint8)
    inside = np.concatenate([[False], (data != 0x20) & ((data < 0x09) | (data > 0x0D)), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if SPECIAL in joined:
        data, given = data.copy(), np.frombuffer(joined, np.uint8)
        for found in re.finditer(re.escape(SPECIAL), joined):
            word = np.searchsorted(starts, found.start(), "right") - 1
            data[starts[word] : ends[word]] = given[starts[word] : ends[word]]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    letters = pa.py_buffer(np.ascontiguousarray(data[inside[1:-1]]))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), letters]
    )
    before = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    return words.dictionary_encode(), np.diff(before, prepend=0)


def encoded(words: list[bytes], tokenizer: Tokenizer, parting: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words in a row, and how many each word has."""
    sizes = np.zeros(len(words), np.int64)
    by_itself = np.fromiter((SPECIAL in word for word in words), bool, len(words))
    plain = np.flatnonzero(~by_itself)
    between = f" {parting} ".encode()
    strings = [
        between.join([words[i] for i in plain[at : at + STRING_WORDS]]).decode() + between.decode()
        for at in range(0, len(plain), STRING_WORDS)
    ]
    made = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
    ids = np.concatenate([np.array(m.ids, np.uint32) for m in made]) if made else np.empty(0, np.uint32)
    parted = ids == tokenizer.token_to_id(parting)
    sizes[plain] = np.diff(np.flatnonzero(parted), prepend=-1) - 1
    ids = ids[~parted]
    alone = np.flatnonzero(by_itself)
    if not len(alone):
        return ids, sizes
    more = tokenizer.encode_batch_fast([words[i].decode() for i in alone], add_special_tokens=False)
    sizes[alone] = [len(m.ids) for m in more]
    # Back into the order of the words.
    pool = np.concatenate([ids, *[np.array(m.ids, np.uint32) for m in more]])
    order = np.concatenate([plain, alone])
    begins = np.empty(len(words), np.int64)
    begins[order] = np.cumsum(sizes[order]) - sizes[order]
    ends = np.cumsum(sizes)
    return pool[np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1])], sizes


class WordMemory:
    """The ids of words by digest, in sorted arrays. When it is full, it keeps the last words only."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.forget()

    def forget(self) -> None:
        self.key, self.check = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.begin, self.size = np.empty(0, np.int64), np.empty(0, np.int32)
        self.pool = np.empty(0, np.uint32)

    def ids(self, words: list[bytes], parting: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and where in it each word's begin and how many it has."""
        digests = b"".join(map(xxhash.xxh3_128_digest, words))
        key, check = np.frombuffer(digests, "<u8").reshape(-1, 2).T
        known = np.zeros(len(words), bool)
        if len(self.key):
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            known = (self.key[at] == key) & (self.check[at] == check)
        new = np.flatnonzero(~known)
        fresh, sizes = encoded([words[i] for i in new], self.tokenizer, parting)
        begin, size = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        if known.any():
            begin[known], size[known] = self.begin[at[known]], self.size[at[known]]
        begin[new], size[new] = len(self.pool) + np.cumsum(sizes) - sizes, sizes
        pool = np.concatenate([self.pool, fresh])
        if len(self.key) + len(new) > REMEMBERED:
            self.forget()
        order = new[np.argsort(key[new])]
        first = len(pool) - len(fresh) if not len(self.key) else 0
        places = np.searchsorted(self.key, key[order])
        self.key = np.insert(self.key, places, key[order])
        self.check = np.insert(self.check, places, check[order])
        self.begin = np.insert(self.begin, places, begin[order] - first)
        self.size = np.insert(self.size, places, size[order])
        self.pool = pool[first:]
        return pool, begin, size


@lru_cache(maxsize=1)
def memory_of(spec: str) -> WordMemory:
    """One for all tasks of a Python worker; as there is a worker for each core, it needs no threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordMemory(Tokenizer.from_str(spec))


def ids_of(texts: list[bytes], memory: WordMemory, method: Packing) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, each closed by the end id, and how many each text has."""
    words, counts = distinct_words(texts)
    pool, begins, sizes = memory.ids(words.dictionary.to_pylist(), method.parting)
    # The end id is the word after each text's last one.
    begins, sizes = np.append(begins, len(pool)), np.append(sizes, 1)
    pool = np.append(pool, np.uint32(method.end))
    numbers = words.indices.to_numpy().astype(np.int64)
    numbers = np.insert(numbers, np.cumsum(counts), len(sizes) - 1)
    taken = sizes[numbers]
    stops = np.cumsum(taken)
    places = np.repeat(begins[numbers] - (stops - taken), taken) + np.arange(stops[-1])
    return pool[places], np.diff(stops[np.cumsum(counts + 1) - 1], prepend=0)


def piece_lengths(tokens: int, longest: int) -> list[int]:
    """Full pieces first, then the binary digits of the rest, largest first."""
    whole, rest = divmod(tokens, longest)
    lengths = [longest] * whole
    while rest:
        part = 1 << (rest.bit_length() - 1)
        lengths.append(part)
        rest -= part
    return lengths


def _packer(method: Packing, spec: str, with_ids: bool):
    def packed(docs: pa.Array, texts: list[bytes], memory: WordMemory) -> pa.RecordBatch:
        ids, sizes = ids_of(texts, memory, method)
        raw, rows, facts, at = memoryview(ids.tobytes()), [], [], 0
        for row, tokens in enumerate(sizes.tolist()):
            start = 0
            for length in piece_lengths(tokens, method.longest):
                rows.append(row)
                facts.append((start, length, zlib.crc32(raw[4 * at : 4 * (at + length)]), tokens))
                start += length
                at += length
        table = np.array(facts, np.int64).reshape(-1, 4)
        columns = [docs.take(pa.array(rows, pa.int64()))]
        columns += [pa.array(np.ascontiguousarray(table[:, i])) for i in range(4)]
        if with_ids:
            # Pieces are cut from the ids one after the other.
            ends = np.concatenate([[0], np.cumsum(table[:, 1])]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.view("<i4"))))
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
        return pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = memory_of(spec)
        for batch in batches:
            sizes = np.cumsum([len(t) for t in batch.column(1).to_pylist()])
            at = 0
            while at < batch.num_rows:
                # At least one text, and no more than fit.
                before = sizes[at - 1] if at else 0
                upto = max(int(np.searchsorted(sizes, before + TEXT_BYTES, "right")), at + 1)
                texts = batch.column(1)[at:upto].to_pylist()
                yield packed(batch.column(0)[at:upto], texts, memory)
                at = upto

    return pack


def pack(
    docs: DataFrame,
    method: Packing,
    id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: the document, its place there, its sequence, and the ids if wanted.

    ``sequence_id`` is unique; ``bucket`` is the binary logarithm of the sequence's length.
    """
    with open(method.tokenizer, encoding="utf-8") as file:
        spec = file.read()
    if Tokenizer.from_str(spec).token_to_id(method.parting) is None:
        raise ValueError(f"the tokenizer has no token {method.parting}")
    texts = docs.select(
        F.col(id).alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    schema = PIECES.format(id=texts.schema["doc_id"].dataType.simpleString())
    if not with_ids:
        schema = schema.rpartition(",")[0]
    pieces = texts.mapInArrow(_packer(method, spec, with_ids), schema)
    return pieces.withColumnRenamed("doc_id", id).withColumns(
        {
            "sequence_id": F.monotonically_increasing_id(),
            "offset": F.lit(0).cast("long"),
            "bucket": F.floor(F.log2("length")).cast("int"),
        }
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store the sequences by bucket, so that a batch of equal lengths is read from one folder."""
    pieces.write.partitionBy("bucket").parquet(path)
