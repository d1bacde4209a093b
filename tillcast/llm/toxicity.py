"""Toxicity by class-conditional Kneser-Ney models.

Two models of the letters in words, one of toxic and one of ordinary documents, are fitted with
shared backoff counts. A text is described by length-normalised comparisons of its likelihoods under both:
of its most telling words, of its best stretch and of the whole. A logistic function turns these into a
score; it is fitted on labelled documents that the models haven't seen.

Counts come from the whole corpus: those of a class from all its labelled rows, the backoff counts from
all documents. Only the logistic function is fitted on a bounded sample of labelled rows, ``sample`` of
each class at most, by hash of the id; the models don't see these. Scoring covers every text in full and
moves nothing but ids and scores. The model goes to every worker in whole, so it grows with the different
sequences of letters in the corpus.

Defined cases: a null or empty text is scored like one without a telling word; labels other than 0 and 1,
and labels without a document, are not learned from; several labels of a document all count; a null id is
never held out; without rows of both classes every score is the share of toxic labels, halfway at first.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tillcast.llm import kneserney as kn
from tillcast.llm.common import small_enough, text_of
from tillcast.session import settled

COUNTS = "sequence string, ordinary long, toxic long, unlabelled long"
CLASSES = ("ordinary", "toxic", "unlabelled")
GATHERED_WORDS = 200_000


@dataclass(frozen=True)
class Learning:
    """Most rows of each class that weights are fitted on; one of so many is kept for that."""

    sample: int = 6000
    calibrating: int = 4
    penalty: float = 1e-3


@dataclass
class Fitted:
    model: kn.Model | None
    center: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.center) / self.spread
        z = np.clip(x @ self.weights[1:] + self.weights[0], -35, 35)
        return 1 / (1 + np.exp(-z))


def remainder(id: Column) -> Column:
    """By this, mod 3, rows are held out from learning."""
    return F.crc32(id.cast("string").cast("binary"))


def held_out(id: Column) -> Column:
    return F.coalesce(remainder(id) % 3 == 1, F.lit(False))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many labels' documents' different words have each sequence of letters, by class.

    Texts that aren't learned from only tell that a sequence exists. Words are gathered over batches.
    """
    by_class, other = (Counter(), Counter()), set()
    for batch in batches:
        for text, *labels in zip(batch["text"], batch["ordinary"], batch["toxic"]):
            words = set(kn.words_of(text))
            if not any(labels):
                other |= words
            for found, times in zip(by_class, labels):
                for _ in range(times):
                    found.update(words)
        if sum(map(len, (*by_class, other))) > GATHERED_WORDS:
            yield _sequences(by_class, other)
            by_class, other = (Counter(), Counter()), set()
    if other or any(by_class):
        yield _sequences(by_class, other)


def _sequences(by_class: tuple[Counter, Counter], other: set[str]) -> pd.DataFrame:
    found = (Counter(), Counter(), dict.fromkeys(s for word in other for s in kn.sequences(word)))
    for of, words in zip(found, by_class):
        for word, n in words.items():
            for sequence in kn.sequences(word):
                of[sequence] += n
    every = list(found[0].keys() | found[1].keys() | found[2].keys())
    counts = {name: [of[s] for s in every] for name, of in zip(CLASSES, found[:2])}
    return pd.DataFrame({"sequence": every, **counts, CLASSES[2]: [int(s in found[2]) for s in every]})


def logistic(x: np.ndarray, y: np.ndarray, penalty: float) -> tuple[np.ndarray, ...]:
    """Center, spread and weights (the constant first) of a logistic regression, by Newton steps."""
    center, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    rows = np.c_[np.ones(len(x)), (x - center) / spread]
    weights = np.zeros(rows.shape[1])
    ridge = penalty * len(y) * np.eye(len(weights))
    ridge[0, 0] = 1e-9
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -35, 35)))
        slope = rows.T @ (y - p) - ridge @ weights
        step = np.linalg.solve((rows * (p * (1 - p))[:, None]).T @ rows + ridge, slope)
        weights += step
        if np.abs(step).max() < 1e-10:
            break
    return center, spread, weights


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learning: Learning = Learning(),
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Fitted:
    """Models and weights from the labelled rows that aren't held out."""
    key, toxic = F.col(id), F.col(label).cast("int")
    usable = labels.where(toxic.isin(0, 1) & key.isNotNull() & ~held_out(key)).select(
        key.alias("key"), toxic.alias("toxic")
    )
    order = [F.xxhash64("key"), "key", "toxic"]
    spare = usable.where(F.floor(remainder(F.col("key")) / 3) % learning.calibrating == 0)
    chosen = [
        spare.where(F.col("toxic") == c).orderBy(*order).limit(learning.sample) for c in (0, 1)
    ]
    chosen = settled(chosen[0].unionByName(chosen[1]))
    named = docs.select(key.alias("of"), text_of(text).alias("text"))
    kept = settled(
        named.join(F.broadcast(chosen), F.col("of") == F.col("key")).select("text", "toxic")
    )
    learned = usable.join(F.broadcast(chosen.select("key").distinct()), "key", "left_anti")
    learned = learned.groupBy("key").agg(
        F.sum(1 - F.col("toxic")).alias("ordinary"), F.sum("toxic").alias("toxic")
    )
    zeros = np.zeros(len(kn.FEATURES))
    labelled = small_enough(settled(learned), 64)
    counts = (
        named.join(labelled, F.col("of") == F.col("key"), "left")
        .select("text", *[F.coalesce(c, F.lit(0)).alias(c) for c in CLASSES[:2]])
        .mapInPandas(_count, COUNTS)
        .groupBy("sequence")
        .agg(*[F.sum(c).alias(c) for c in CLASSES])
    )
    counts = counts.toArrow().sort_by("sequence")
    model = kn.Model(zip(*(counts[c].to_pylist() for c in ("sequence", *CLASSES))))
    described = kept.select("toxic", _describe(kept, model)(F.col("text")).alias("x")).toArrow()
    y = np.array(described["toxic"].to_pylist(), float)
    if not 0 < y.sum() < len(y):
        known = named.select("of").join(usable, F.col("of") == F.col("key"))
        rows, ones = known.agg(F.count("*"), F.sum("toxic")).first()
        share = ((ones or 0) + 1) / (rows + 2)
        weights = np.r_[np.log(share / (1 - share)), zeros]
        return Fitted(model, zeros, zeros + 1, weights)
    x = np.array(described["x"].to_pylist())
    order = np.lexsort((*x.T, y))  # sums don't depend on the order rows come in
    return Fitted(model, *logistic(x[order], y[order], learning.penalty))


def _describe(frame: DataFrame, model: kn.Model):
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def describe(texts: pd.Series) -> pd.Series:
        return pd.Series([list(kn.features(shared.value, text)) for text in texts], dtype=object)

    return pandas_udf(describe, "array<double>")


def score(docs: DataFrame, fitted: Fitted, text: str = "text") -> Column:
    """The score of each text, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def rate(texts: pd.Series) -> pd.Series:
        fitted = shared.value
        rows = [kn.features(fitted.model, text) for text in texts]
        return pd.Series(fitted.scores(np.array(rows).reshape(-1, len(kn.FEATURES))))

    return pandas_udf(rate, "double")(text_of(text))
