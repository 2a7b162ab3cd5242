"""Cumulative-link ordinal regression on sparse presence features, shared by operators 1 and 2.

``P(grade > j) = logistic(w . x - t_j)`` with one weight vector for all thresholds ``t_0 < t_1 < ...``.
The fit runs on the driver over a bounded sample of labelled rows; features are screened first, so
that a long text's thousands of indifferent words add nothing to its score."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
import xxhash


@dataclass
class Ordinal:
    """``weights`` by feature (at most as many as were screened in), ascending ``thresholds``."""

    weights: dict[Hashable, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)
    constant: int = 0  # the only grade seen, where there were no two to tell apart

    def tails(self, features: set) -> list[float]:
        """``P(grade > j)`` for each threshold."""
        if not self.thresholds:
            return []
        score = sum(map(self.weights.__getitem__, self.weights.keys() & features))
        return [float(1 / (1 + np.exp(min(700.0, t - score)))) for t in self.thresholds]

    def expected(self, tails: list[float]) -> float:
        return sum(tails) if self.thresholds else float(self.constant)

    def grade(self, tails: list[float]) -> int:
        return sum(t >= 0.5 for t in tails) if self.thresholds else self.constant


class Rows:
    """Presence features of many rows in one flat array of numbers; features that are no numbers are known by their hash."""

    def __init__(self, rows: Iterable[Iterable[Hashable]] = ()):
        parts = [self._numbers(r) for r in rows]
        self.values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.ends = np.cumsum([len(p) for p in parts], dtype=np.int64)

    @staticmethod
    def _numbers(row: Iterable[Hashable]) -> np.ndarray:
        return np.unique(np.fromiter((number(f) for f in row), np.int64))

    def __len__(self) -> int:
        return len(self.ends)

    def row(self, i: int) -> np.ndarray:
        return self.values[self.ends[i - 1] if i else 0 : self.ends[i]]

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self), dtype=np.int32), np.diff(self.ends, prepend=0))


def number(feature: Hashable) -> int:
    """A number as it is, a text as 64 bits of it."""
    return feature if isinstance(feature, int) else xxhash.xxh64_intdigest(feature) - (1 << 63)


def screened(rows: Rows, grades: np.ndarray, min_rows: int, most: int, z: float) -> np.ndarray:
    """Features in at least ``min_rows`` rows whose mean grade is ``z`` standard errors off the mean of all;
    the ``most`` furthest off.  Both limits are lower where few rows stand for one side: a feature must be in a quarter of that side's
    rows at most, and 0.35 times as far off as one that is in all of them and in no others."""
    few = min(int((grades > 0).sum()), int((grades == 0).sum())) or len(grades)
    z = min(z, 0.35 * np.sqrt(len(grades) - few))
    min_rows = min(min_rows, max(2, few // 4))
    found, at, n = np.unique(rows.values, return_inverse=True, return_counts=True)
    total = np.bincount(at, grades[rows.owners()], len(found))
    off = np.abs(total / n - grades.mean()) * np.sqrt(n) / (grades.std() or 1.0)
    order = [i for i in np.lexsort([found, -off]) if n[i] >= min_rows and off[i] >= z]
    return found[order[:most]]


def fit(
    features: Sequence[Iterable[Hashable]] | Rows, grades: Sequence[int], min_rows: int = 8, most: int = 512, z: float = 8.0,
    decay: float = 1e-5, steps: int = 800, rate: float = 0.1,
) -> Ordinal:
    """Maximum likelihood with weight decay by full-batch Adam; the same sample gives the same model."""
    given = features
    features = given if isinstance(given, Rows) else Rows(given)
    y = np.asarray(grades, np.int64)
    if len(y) == 0 or y.min() == y.max():
        return Ordinal(constant=int(y[0]) if len(y) else 0)
    names = screened(features, y, min_rows, most, z)
    by_value = np.argsort(names)
    if len(names):  # the screened features as pairs of row and column
        found = np.minimum(np.searchsorted(names[by_value], features.values), len(names) - 1)
        hit = names[by_value][found] == features.values
        rows, cols = features.owners()[hit], by_value[found[hit]]
    else:
        rows, cols = np.zeros(0, np.int64), np.zeros(0, np.int64)
    top = int(y.max())
    share = np.array([(y > j).mean() for j in range(top)])
    share = np.clip(share, 1e-4, 1 - 1e-4)
    cuts = np.log((1 - share) / share)
    cuts = np.maximum.accumulate(cuts + 1e-3 * np.arange(top))
    # thresholds as a first one and the logarithms of the gaps, so that they stay in order
    params = np.concatenate([np.zeros(len(names)), cuts[:1], np.log(np.diff(cuts) + 1e-3)])
    m, v = np.zeros_like(params), np.zeros_like(params)
    n, k = len(y), len(names)

    def thresholds(p: np.ndarray) -> np.ndarray:
        return p[k] + np.concatenate([[0.0], np.cumsum(np.exp(p[k + 1 :]))])

    def logistic(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -60, 60)))

    for step in range(1, steps + 1):
        t = thresholds(params)
        score = np.bincount(rows, params[cols], n)
        upper, lower = np.ones(n), np.zeros(n)  # logistic of the thresholds on both sides of the grade
        below, above = y < top, y > 0
        upper[below] = logistic(t[y[below]] - score[below])
        lower[above] = logistic(t[y[above] - 1] - score[above])
        p = np.maximum(upper - lower, 1e-12)
        by_score = upper + lower - 1  # derivative of log p
        by_cut = np.zeros(top)
        np.add.at(by_cut, y[below], (upper * (1 - upper) / p)[below])
        np.add.at(by_cut, y[above] - 1, -(lower * (1 - lower) / p)[above])
        grad = np.zeros_like(params)
        grad[:k] = -np.bincount(cols, by_score[rows], k) / n + decay * params[:k]
        tail = np.cumsum(by_cut[::-1])[::-1]
        grad[k] = -tail[0] / n
        grad[k + 1 :] = -tail[1:] * np.exp(params[k + 1 :]) / n
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        params = params - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = dict(zip(names.tolist(), params[:k].tolist()))
    if given is not features:  # under the names they were given by
        weights = {f: weights[number(f)] for x in given for f in x if number(f) in weights}
    return Ordinal(weights, thresholds(params).tolist())
