"""Sparse logistic regression on hashed binary features, fitted in numpy."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash


def feature(name: str | bytes) -> int:
    """64-bit hash of a feature's name, signed."""
    h = xxhash.xxh3_64_intdigest(name)
    return h - (1 << 64) if h >> 63 else h


class Rows:
    """Binary rows over the columns of a sorted vocabulary of feature hashes."""

    def __init__(self, lists: list[np.ndarray], vocabulary: np.ndarray):
        own = []
        for x in lists:
            at = np.searchsorted(vocabulary, x)
            at[at == len(vocabulary)] = 0
            own.append(at[vocabulary[at] == x] if len(vocabulary) else at[:0])
        self.n, self.width = len(own), len(vocabulary)
        self.row = np.repeat(np.arange(len(own)), [len(x) for x in own])
        self.col = np.concatenate(own) if own else np.zeros(0, np.int64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, g[self.row], minlength=self.width)


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, float)))


def fit(rows: Rows, target: np.ndarray, l2: float, pairs: Sequence[tuple[Rows, Rows, float]] = (),
        steps: int = 300, rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Weights and bias for soft targets, by Adam on the full batch.

    ``pairs`` are groups (rows, rows that should score alike, weight): the mean squared
    score difference of a group is penalised with its weight.
    """
    w, n = np.zeros(rows.width), max(1, rows.n)
    p = min(max(float(target.mean()) if rows.n else 0.25, 0.01), 0.99)
    theta = np.append(w, np.log(p / (1 - p)))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, b = theta[:-1], theta[-1]
        err = sigmoid(rows.dot(w) + b) - target
        grad = np.append(rows.back(err) / n + l2 * w, err.sum() / n)
        for one, other, weight in pairs:
            gap = one.dot(w) - other.dot(w)
            grad[:-1] += weight * 2 * (one.back(gap) - other.back(gap)) / one.n
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])
