"""Gradient-boosted regression trees for a binary label, over binned features."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Complete trees of one depth; each split compares a feature with a threshold."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 48, least: float = 5.0):
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least
        self.feature: list[np.ndarray] = []
        self.threshold: list[np.ndarray] = []
        self.value: list[np.ndarray] = []
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, width = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(width)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        score = np.full(n, self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            leaf = np.zeros(n, np.int64)
            features, thresholds = np.zeros((1 << self.depth) - 1, np.int64), np.full((1 << self.depth) - 1, np.inf)
            for level in range(self.depth):
                nodes = 1 << level
                best = np.full(nodes, 1e-6)
                choice = np.full((nodes, 2), -1)
                for j in range(width):
                    key = leaf * (self.bins + 1) + binned[:, j]
                    g = np.bincount(key, grad, nodes * (self.bins + 1)).reshape(nodes, -1).cumsum(axis=1)
                    h = np.bincount(key, hess, nodes * (self.bins + 1)).reshape(nodes, -1).cumsum(axis=1)
                    all_g, all_h = g[:, -1:], h[:, -1:]
                    gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
                    gain[(h < self.least) | (all_h - h < self.least)] = 0
                    gain[:, len(edges[j]) :] = 0
                    at = gain.argmax(axis=1)
                    top = gain[np.arange(nodes), at]
                    better = top > best
                    best[better] = top[better]
                    choice[better] = np.stack([np.full(nodes, j), at], axis=1)[better]
                first = nodes - 1
                for k in range(nodes):
                    if choice[k, 0] >= 0:
                        features[first + k], thresholds[first + k] = choice[k, 0], edges[choice[k, 0]][choice[k, 1]]
                leaf = leaf * 2 + (x[np.arange(n), features[first + leaf]] > thresholds[first + leaf])
            g, h = np.bincount(leaf, grad, 1 << self.depth), np.bincount(leaf, hess, 1 << self.depth)
            value = self.rate * g / (h + 1)
            self.feature.append(features), self.threshold.append(thresholds), self.value.append(value)
            score += value[leaf]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Log odds of label 1."""
        score, rows = np.full(len(x), self.start), np.arange(len(x))
        for features, thresholds, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, features[node]] > thresholds[node])
            score += value[node - ((1 << self.depth) - 1)]
        return score
