"""Class-conditional Kneser-Ney models of the letters in words, over shared backoff counts.

Plain Python for use inside tasks. A word is seen as ``^word$``. Each class has its own counts of the
longest letter sequences; what a class hasn't seen is left to one model of shorter sequences whose
counts are numbers of different continuations, added up over both classes and the unlabelled texts. So an
expression that is rare everywhere has nearly equal likelihoods, and only what one class really says more
often tells.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable

import numpy as np

CONTEXT = 5  # letters before the one that is predicted
DISCOUNT = 0.75
CACHED_WORDS = 500_000
CACHED_SEQUENCES = 1_000_000
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return LETTERS.findall(text.lower())


def sequences(word: str) -> list[str]:
    """Every letter of the word, and its end, behind its context."""
    marked, size = f"^{word}$", CONTEXT + 1
    short = [marked[:i] for i in range(2, min(len(marked), size) + 1)]
    return short + [marked[i : i + size] for i in range(1, len(marked) - CONTEXT)]


class Model:
    """Likelihoods of words under two classes.

    Made from counts of (sequence, class 0, class 1); a further count, of unlabelled texts, only adds
    to the backoff counts.
    """

    def __init__(self, counts: Iterable[tuple[str, int, ...]]):
        own = (Counter(), Counter())
        lower = Counter()
        for sequence, *by_class in counts:
            for c in (0, 1):
                if by_class[c]:
                    own[c][sequence] = by_class[c]
            if len(sequence) > 1:
                lower[sequence[1:]] += sum(map(bool, by_class))
        every = Counter(lower)
        level = lower
        for _ in range(CONTEXT):
            level = Counter(s[1:] for s in level if len(s) > 1)
            every.update(level)
        self.alphabet = len({s[-1] for s in every}) + 1
        self.seen, self.left = _discounted(every)
        self.seen_by, self.left_by = zip(*map(_discounted, own))
        self.steps = Steps(self)
        self.words = Words(self.steps)

    def backoff(self, sequence: str) -> float:
        """Probability of the last letter behind the rest, by continuations of both classes."""
        found, weight = 0.0, 1.0
        while sequence:
            context = sequence[:-1]
            if context in self.left:
                found += weight * self.seen.get(sequence, 0.0)
                weight *= self.left[context]
            sequence = sequence[1:]
        return found + weight / self.alphabet

    def step(self, sequence: str) -> float:
        """Log-likelihood of the last letter under class 1 less that under class 0."""
        context = sequence[:-1]
        shares = [left.get(context) for left in self.left_by]
        if shares == [None, None]:
            return 0.0  # both leave it to the shared counts
        rest = self.backoff(sequence[1:])
        p = [
            rest if share is None else seen.get(sequence, 0.0) + share * rest
            for seen, share in zip(self.seen_by, shares)
        ]
        return math.log(p[1] / p[0])


class Steps(dict):
    """What each sequence of letters tells, remembered; forgets everything when it holds too many."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, sequence: str) -> float:
        if len(self) >= CACHED_SEQUENCES:
            self.clear()
        self[sequence] = made = self.model.step(sequence)
        return made


class Words(dict):
    """What each word tells, all its letters added up; remembered likewise."""

    def __init__(self, steps: Steps):
        super().__init__()
        self.steps = steps

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = made = sum(map(self.steps.__getitem__, sequences(word)))
        return made


def _discounted(counts: Counter) -> tuple[dict[str, float], dict[str, float]]:
    """Discounted share of each sequence behind its context, and what each context leaves over."""
    total, kinds = Counter(), Counter()
    for sequence, n in counts.items():
        total[sequence[:-1]] += n
        kinds[sequence[:-1]] += 1
    seen = {s: (n - DISCOUNT) / total[s[:-1]] for s, n in counts.items()}
    left = {context: DISCOUNT * kinds[context] / n for context, n in total.items()}
    return seen, left


#: What is known of a text: how telling its most telling words are, each different word once, with
#: their letters added up and by letter, the same of its best stretch and of all of it, and its size.
TOP = 4
FEATURES = tuple(f"{kind}_{i}" for kind in ("sum", "mean") for i in range(TOP)) + (
    "stretch",
    "whole",
    "size",
)
STRETCH = 20


def features(model: Model, text: str) -> tuple[float, ...]:
    """Likelihood comparisons of the text at several scales; zeros for a text without letters."""
    words = words_of(text)
    if not words:
        return (0.0,) * len(FEATURES)
    told = model.words
    different = list(set(words))
    sums = np.fromiter(map(told.__getitem__, different), float, len(different))
    means = sums / (np.fromiter(map(len, different), float, len(different)) + 1)
    tops = []
    for kind in (sums, means):
        top = np.sort(np.partition(kind, -TOP)[-TOP:] if len(kind) > TOP else kind)[::-1]
        tops += [max(x, 0.0) for x in top.tolist()] + [0.0] * (TOP - len(top))
    upto = np.zeros((2, len(words) + 1))
    np.cumsum(np.fromiter(map(told.__getitem__, words), float, len(words)), out=upto[0, 1:])
    np.cumsum(np.fromiter(map(len, words), float, len(words)) + 1, out=upto[1, 1:])
    stretch = min(STRETCH, len(words))
    inside = upto[:, stretch:] - upto[:, :-stretch]
    whole = upto[0, -1] / upto[1, -1]
    return (*tops, float((inside[0] / inside[1]).max()), float(whole), math.log(len(different)))
