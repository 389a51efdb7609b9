"""Boosted trees over features with few levels, fitted from counts.

All rows with equal features are one line of a table: their features, how many there are and how many are positive. That
table is small however many rows were counted, so the fit is exact over all rows and the driver holds the levels alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Node:
    value: float = 0.0
    feature: str = ""
    at_most: int = 0
    low: Node | None = None
    high: Node | None = None

    def column(self) -> Column:
        if not self.feature:
            return F.lit(float(self.value))
        return F.when(F.col(self.feature) <= self.at_most, self.low.column()).otherwise(self.high.column())

    def of(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        if not self.feature:
            return np.full(len(x), self.value)
        return np.where(x[:, names.index(self.feature)] <= self.at_most, self.low.of(x, names), self.high.of(x, names))


@dataclass
class Boosted:
    names: list[str]
    start: float
    trees: list[Node]

    def column(self) -> Column:
        """The probability as an expression over columns of the features' names."""
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + tree.column()
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def of(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.start + sum((t.of(x, self.names) for t in self.trees), np.zeros(len(x))))))


def _grow(x: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, names: list[str], depth: int, rate: float, ridge: float) -> Node:
    def gain(g: float, h: float) -> float:
        return g * g / (h + ridge)

    leaf = Node(rate * gradient.sum() / (hessian.sum() + ridge))
    if depth == 0:
        return leaf
    best, whole = (1e-6, "", 0), gain(gradient.sum(), hessian.sum())
    for k, name in enumerate(names):
        for level in np.unique(x[:, k])[:-1]:
            low = x[:, k] <= level
            got = gain(gradient[low].sum(), hessian[low].sum()) + gain(gradient[~low].sum(), hessian[~low].sum()) - whole
            if got > best[0] + 1e-12:
                best = (got, name, int(level))
    if not best[1]:
        return leaf
    low = x[:, names.index(best[1])] <= best[2]
    down = [_grow(x[m], gradient[m], hessian[m], names, depth - 1, rate, ridge) for m in (low, ~low)]
    return Node(0.0, best[1], best[2], *down)


def fit(x: np.ndarray, n: np.ndarray, positive: np.ndarray, names: list[str], rounds: int = 30, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> Boosted:
    """x: one line for each combination of features; n: rows of it; positive: those labelled 1. Log loss, Newton steps."""
    share = (positive.sum() + 1) / (n.sum() + 2)
    model = Boosted(names, float(np.log(share / (1 - share))), [])
    score = np.full(len(x), model.start)
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, positive - n * p, n * p * (1 - p), names, depth, rate, ridge)
        model.trees.append(tree)
        score += tree.of(x, names)
    return model


def threshold(score: np.ndarray, n: np.ndarray, positive: np.ndarray, precision: float, least: float = 0.5) -> float:
    """The lowest score from which on at least `precision` of the rows are positive; 1.01 where none is good enough."""
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(positive[order]) / np.maximum(np.cumsum(n[order]), 1)
    ends = np.concatenate((score[order][1:] != score[order][:-1], [True])) if len(order) else np.zeros(0, bool)
    good = [float(s) for s, q, e in zip(score[order], share, ends, strict=True) if e and q >= precision and s >= least]
    return min(good, default=1.01)
