"""Gradient-boosted decision trees for two classes, fitted with NumPy and applied as a Spark expression."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

Tree = float | tuple[str, float, "Tree", "Tree"]


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, names: list[str], depth: int, least: int, cuts: list[np.ndarray]) -> Tree:
    """The tree of Newton steps that lowers the loss most, split at quantiles."""
    total_g, total_h = g.sum(), h.sum()
    best = (1e-6, -1, 0.0)
    if depth and len(g) >= 2 * least:
        for k, at in enumerate(cuts):
            if not len(at):
                continue
            bins = np.searchsorted(at, x[:, k], side="right")
            gs, hs, ns = (np.bincount(bins, w, len(at) + 1).cumsum()[:-1] for w in (g, h, None))
            gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
            gain[(ns < least) | (len(g) - ns < least)] = 0
            if gain.max() > best[0]:
                best = (gain.max(), k, at[gain.argmax()])
    if best[1] < 0:
        return float(-total_g / (total_h + 1))
    _, k, cut = best
    left = x[:, k] < cut
    return names[k], float(cut), _grow(x[left], g[left], h[left], names, depth - 1, least, cuts), _grow(x[~left], g[~left], h[~left], names, depth - 1, least, cuts)


def _values(tree: Tree, x: np.ndarray, names: list[str]) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    name, cut, low, high = tree
    return np.where(x[:, names.index(name)] < cut, _values(low, x, names), _values(high, x, names))


class Boosted:
    """A sum of trees; score() is the log odds of class 1."""

    def __init__(self, names: list[str], rounds: int = 12, depth: int = 3, rate: float = 0.5, least: int = 5):
        self.names, self.rounds, self.depth, self.rate, self.least = names, rounds, depth, rate, least
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        """x: rows of features without NaN; y: 0 or 1. With no rows or one class the score is constant."""
        x, y = np.asarray(x, float).reshape(-1, len(self.names)), np.asarray(y, float)
        share = min(max((y.sum() + 0.5) / (len(y) + 1), 1e-6), 1 - 1e-6)
        self.base, self.trees = math.log(share / (1 - share)), []
        if len(y) == 0 or y.min() == y.max():
            return self
        cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, 33)[1:])) for k in range(x.shape[1])]
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree = _grow(x, p - y, np.maximum(p * (1 - p), 1e-9), self.names, self.depth, self.least, cuts)
            self.trees.append(tree)
            score += self.rate * _values(tree, x, self.names)
        return self

    def fixed(self, score: float) -> Boosted:
        """A model that gives every row this score, as a stand-in for one that is fitted."""
        self.base, self.trees = score, []
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float).reshape(-1, len(self.names))
        return self.base + self.rate * sum((_values(t, x, self.names) for t in self.trees), np.zeros(len(x)))

    def column(self) -> Column:
        """The score as nested conditions over columns of the features' names."""

        def nested(tree: Tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            return F.when(F.col(tree[0]) < tree[1], nested(tree[2])).otherwise(nested(tree[3]))

        out = F.lit(self.base)
        for t in self.trees:
            out = out + F.lit(self.rate) * nested(t)
        return out
