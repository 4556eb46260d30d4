"""Logistic regression on sparse rows: a bounded sample is fitted with numpy, all rows are scored in tasks."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


class Sparse:
    """Rows of (column, value); values are 1 where none are given."""

    def __init__(self, lengths, columns, values=None):
        self.n = len(lengths)
        self.row = np.repeat(np.arange(self.n), np.asarray(lengths, dtype=np.int64))
        self.column = np.asarray(columns, dtype=np.int64)
        self.value = np.ones(len(self.column)) if values is None else np.asarray(values, dtype=np.float64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.column] * self.value, minlength=self.n)

    def back(self, g: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.column, weights=g[self.row] * self.value, minlength=width)


def fit(x: Sparse, y: np.ndarray, width: int, l2: float, steps: int = 300, rate: float = 0.1, pairs: Sparse | None = None, pair_weight: float = 0.0, balance: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the mean log loss, l2 * |w|^2 and pair_weight * mean((d.w)^2).

    ``balance`` weighs class 1 by (negatives / positives) to that power. ``pairs`` holds differences d between the features of a row and of its counterfactual. Full-batch Adam with a falling
    rate: the same rows give the same result. Without both classes the weights are 0 and the intercept is the prior's.
    """
    w, b = np.zeros(width), 0.0
    y = np.asarray(y, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return w, (40.0 if len(y) and y[0] == 1 else -40.0)
    heavy = np.where(y == 1, (1 - y.mean()) / y.mean(), 1.0) ** balance
    heavy /= heavy.sum()
    prior = float((heavy * y).sum())
    b = float(np.log(prior / (1 - prior)))
    m = v = np.zeros(width + 1)
    for k in range(1, steps + 1):
        miss = (sigmoid(x.dot(w) + b) - y) * heavy
        g = x.back(miss, width) + 2 * l2 * w
        if pairs is not None and pairs.n:
            g += pairs.back(2 * pair_weight * pairs.dot(w) / pairs.n, width)
        g = np.append(g, miss.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        step = rate * (1 - k / (steps + 1)) * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
        w -= step[:-1]
        b -= float(step[-1])
    return w, b
