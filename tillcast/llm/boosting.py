"""Gradient-boosted trees on a table of numbers, for two classes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Trees of equal depth as arrays: at each inner place a column and a bound, at each leaf a value."""

    columns: np.ndarray
    bounds: np.ndarray
    values: np.ndarray
    start: float = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log odds of class 1."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.columns.shape[1]
        depth = (inner + 1).bit_length() - 1
        for column, bound, value in zip(self.columns, self.bounds, self.values):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, column[at]] > bound[at])
            total += value[at - inner]
        return total


@dataclass(frozen=True)
class Boosting:
    trees: int = 120
    depth: int = 4
    rate: float = 0.25
    bins: int = 16
    penalty: float = 2.0
    least_curve: float = 1.0
    columns: float = 0.35  # share of the columns that a tree may look at


def fit(x: np.ndarray, y: np.ndarray, method: Boosting = Boosting()) -> Boosted:
    """Second-order boosting of the logistic loss over binned columns."""
    edges = [
        np.unique(np.quantile(column, np.linspace(0, 1, method.bins + 1)[1:-1])) for column in x.T
    ]
    binned = np.stack(
        [np.searchsorted(edge, column, side="left") for edge, column in zip(edges, x.T)], axis=1
    )
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    score = np.full(len(y), start)
    inner = 2**method.depth - 1
    shape = (method.trees, inner)
    columns, bounds = np.zeros(shape, np.int64), np.full(shape, np.inf)
    values = np.zeros((method.trees, inner + 1))
    width = method.bins
    chance = np.random.default_rng(7)
    useful = np.array([c for c, edge in enumerate(edges) if len(edge)])
    for tree in range(method.trees):
        looked = chance.permutation(useful)[: max(1, round(method.columns * len(useful)))]
        p = 1 / (1 + np.exp(-score))
        slope, curve = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(method.depth):
            first, count = 2**level - 1, 2**level
            local = at - first
            best = np.full(count, 1e-9)
            for c in looked:
                key = local * width + binned[:, c]
                g, h = (
                    np.bincount(key, w, count * width).reshape(count, width).cumsum(axis=1)
                    for w in (slope, curve)
                )
                gt, ht = g[:, -1:], h[:, -1:]
                gain = (
                    g**2 / (h + method.penalty)
                    + (gt - g) ** 2 / (ht - h + method.penalty)
                    - gt**2 / (ht + method.penalty)
                )
                gain[(h < method.least_curve) | (ht - h < method.least_curve)] = 0
                gain = gain[:, : len(edges[c])]
                cut = gain.argmax(axis=1)
                top = gain[np.arange(count), cut]
                for node in np.flatnonzero(top > best):
                    best[node] = top[node]
                    columns[tree, first + node] = c
                    bounds[tree, first + node] = edges[c][cut[node]]
            at = 2 * at + 1 + (x[np.arange(len(y)), columns[tree, at]] > bounds[tree, at])
        leaf = at - inner
        g = np.bincount(leaf, slope, inner + 1)
        h = np.bincount(leaf, curve, inner + 1)
        values[tree] = method.rate * g / (h + method.penalty)
        score += values[tree][leaf]
    return Boosted(columns, bounds, values, start)
