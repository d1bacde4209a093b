"""Word shingles as 64-bit numbers, and SuperMinHash signatures over them, batch by batch.

Plain array code for use inside Spark tasks. A text's words are its runs without ASCII white space,
A-Z in lower case. A text with fewer words than a shingle has its whole sequence as one shingle.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import xxhash

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
CACHED_WORDS = 500_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """A word's hash, remembered; forgets everything when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = made = xxhash.xxh3_64_intdigest(word)
        return made


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # for bytes both look at ASCII only


def shingled(texts: list[list[bytes]], k: int, hashes: WordHashes) -> list[np.ndarray]:
    """For each text, given as its words, the sorted distinct shingle hashes."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    words = map(hashes.__getitem__, chain.from_iterable(texts))
    return sets_of(np.fromiter(words, np.uint64, int(sizes.sum())), np.cumsum(sizes) - sizes, sizes, k)


def sets_of(words: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, k: int) -> list[np.ndarray]:
    """The same for texts given as the first and the number of their words, by the words' hashes."""
    rolled = np.zeros(max(len(words) - k + 1, 0), np.uint64)
    for i in range(k):
        rolled = mixed(rolled + GOLDEN + words[i : i + len(rolled)])
    ends = np.cumsum(np.where(sizes < k, np.minimum(sizes, 1), sizes - k + 1))
    every = np.empty(ends[-1] if len(ends) else 0, np.uint64)
    kept = np.ones(len(every) + 1, bool)
    at = 0
    for first, size, end in zip(firsts.tolist(), sizes.tolist(), ends.tolist()):
        if size >= k:
            every[at:end] = rolled[first : first + end - at]
            every[at:end].sort()
        elif size:
            whole = np.array([size], np.uint64)
            for word in words[first : first + size]:
                whole = mixed(whole + word)
            every[at:end] = whole
        at = end
    kept[1:-1] = every[1:] != every[:-1]
    kept[ends] = True  # a set's first is the next one's, if it is empty
    bounds = np.concatenate([[0], np.cumsum(kept[:-1])])[np.concatenate([[0], ends])].tolist()
    every = every[kept[:-1]]
    return [every[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def digest(shingles: np.ndarray) -> bytes:
    """Equal for equal sets."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


@dataclass(frozen=True)
class Banding:
    """``bands`` of ``rows`` signature slots each."""

    rows: int
    bands: int

    @property
    def slots(self) -> int:
        return self.rows * self.bands

    @classmethod
    def tuned(cls, similarity: float, miss: float = 1e-6, slots: int = 128) -> Banding:
        """The most selective banding that overlooks a pair at ``similarity`` with chance ``miss``."""
        for rows in range(16, 0, -1):
            bands = int(np.ceil(np.log(miss) / np.log1p(-(similarity**rows))))
            if rows * bands <= slots:
                return cls(rows, bands)
        raise ValueError("no banding with so few slots is that sure")


def superminhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """One row of ``slots`` values for each set; the values of an empty set are all the largest.

    Every element draws a permutation of the slots, one step after the other; the value it offers
    to the slot of its step j lies between j and j + 1. As a later step can't beat an earlier
    one, a set is done as soon as all its slots have a value of a step that was taken, which for
    a set much larger than ``slots`` is the first. All sets of the batch take a step together.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    signature = np.full((len(sets), slots), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64)
    if not sizes.sum():
        return signature
    flat = signature.reshape(-1)
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = None
    for step in range(slots):
        drawn = mixed(element + np.uint64((int(GOLDEN) * (step + 1)) % 2**64))
        value = (np.uint64(step) << np.uint64(32)) | (drawn >> np.uint64(32))
        other = ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(slots - step)) >> np.uint64(32)
        other = other.astype(np.int64) + step
        if order is None:
            slot = other
        else:
            rows = np.arange(len(element))
            slot = order[rows, other].astype(np.int64)
            order[rows, other] = order[:, step]
        np.minimum.at(flat, owner * slots + slot, value)
        open_sets = (signature >> np.uint64(32)).max(axis=1) > step
        if order is None:
            going = open_sets[owner]
            element, owner, other = element[going], owner[going], other[going]
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(element), 1))
            order[np.arange(len(element)), other] = 0
        else:
            going = open_sets[owner]
            if going.mean() < 0.8:
                element, owner, order = element[going], owner[going], order[going]
        if not going.any():
            break
    return signature


def band_keys(signature: np.ndarray, banding: Banding) -> np.ndarray:
    """One 64-bit key for each set and band; keys of different bands differ."""
    cut = signature[:, : banding.slots].reshape(len(signature), banding.bands, banding.rows)
    key = np.tile(np.arange(1, banding.bands + 1, dtype=np.uint64), (len(signature), 1))
    for i in range(banding.rows):
        key = mixed(key * GOLDEN + cut[:, :, i])
    return key.view(np.int64)


def sketches(signature: np.ndarray) -> np.ndarray:
    """The signature at 8 bits a slot, eight slots in a number, for a quick estimate."""
    low = (mixed(signature) & np.uint64(0xFF)).astype(np.uint8)
    spare = -low.shape[1] % 8
    return np.pad(low, ((0, 0), (0, spare))).view(np.int64)
