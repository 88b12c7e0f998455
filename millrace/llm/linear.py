"""Logistic regression on sparse binary features, for bounded samples, in numpy."""

from __future__ import annotations

import numpy as np


class Rows:
    """Rows of column numbers, as one flat array with offsets."""

    def __init__(self, lists: list[np.ndarray]):
        self.count = len(lists)
        sizes = np.array([len(x) for x in lists], np.int64)
        self.row = np.repeat(np.arange(self.count), sizes)
        self.column = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.count)

    def gather(self, values: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.column, values[self.row], width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(
    rows: Rows, dense: np.ndarray, target: np.ndarray, width: int, penalty: float, steps: int = 250
) -> tuple[np.ndarray, np.ndarray, float]:
    """``(sparse weights, dense weights, bias)`` by accelerated gradient steps with a diagonal bound on the curvature.

    Without rows everything is 0.
    """
    n, k = rows.count, dense.shape[1]
    if not n:
        return np.zeros(width), np.zeros(k), 0.0
    each = np.maximum(np.bincount(rows.row, minlength=rows.count), 1).astype(float)
    # The Hessian lies below diag(sum of each column's squares times the row's features) / 4.
    reach = each + np.abs(dense).sum(axis=1) + 1
    sparse_step = 1 / (rows.gather(reach, width) / 4 / n + penalty)
    dense_step = 1 / ((np.abs(dense) * reach[:, None]).sum(axis=0) / 4 / n + penalty)
    bias_step = 1 / (reach.sum() / 4 / n)
    w, v, b = np.zeros(width), np.zeros(k), 0.0
    at_w, at_v, at_b, pace = w, v, b, 1.0
    for _ in range(steps):
        error = sigmoid(rows.times(at_w) + dense @ at_v + at_b) - target
        new_w = at_w - sparse_step * (rows.gather(error, width) / n + penalty * at_w)
        new_v = at_v - dense_step * (dense.T @ error / n + penalty * at_v)
        new_b = at_b - bias_step * error.mean()
        faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        push = (pace - 1) / faster
        at_w, at_v, at_b = new_w + push * (new_w - w), new_v + push * (new_v - v), new_b + push * (new_b - b)
        w, v, b, pace = new_w, new_v, new_b, faster
    return w, v, float(b)
