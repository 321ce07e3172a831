"""A small classification tree: binary splits by Gini impurity, learned from a labelled table."""

from __future__ import annotations

import numpy as np


class Tree:
    """Splits ``x[column] <= threshold``; ties go to the first column and the lowest threshold."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8):
        self.share = float(y.mean()) if len(y) else 0.0
        self.column = None
        split = self._best(x, y) if depth and 0 < self.share < 1 else None
        if split:
            self.column, self.threshold = split
            low = x[:, self.column] <= self.threshold
            self.low, self.high = Tree(x[low], y[low], depth - 1), Tree(x[~low], y[~low], depth - 1)

    @staticmethod
    def _best(x: np.ndarray, y: np.ndarray) -> tuple[int, float] | None:
        best, found = y.mean() * (1 - y.mean()) * len(y) - 1e-9, None
        for column in range(x.shape[1]):
            order = np.argsort(x[:, column], kind="stable")
            values, ones = x[order, column], np.cumsum(y[order])
            n = np.arange(1, len(y))
            left, right = ones[:-1], ones[-1] - ones[:-1]
            cost = left * (n - left) / n + right * (len(y) - n - right) / (len(y) - n)
            cost = np.where(values[1:] > values[:-1], cost, np.inf)
            at = int(np.argmin(cost)) if len(cost) else -1
            if at >= 0 and cost[at] < best:
                best, found = cost[at], (column, float(values[at] + values[at + 1]) / 2)
        return found

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Share of positive labels in the leaf of every row."""
        if self.column is None:
            return np.full(len(x), self.share)
        low = x[:, self.column] <= self.threshold
        out = np.empty(len(x))
        out[low], out[~low] = self.low.predict(x[low]), self.high.predict(x[~low])
        return out
