"""Gradient-boosted trees for two classes, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Trees of one depth as flat arrays: node k of a tree has the children 2k+1 and 2k+2."""

    start: float
    features: np.ndarray  # trees x inner nodes
    limits: np.ndarray
    leaves: np.ndarray  # trees x leaves

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of each row; a row goes right where its feature is above the limit."""
        found = np.full(len(rows), self.start)
        inner, every = self.features.shape[1], np.arange(len(rows))
        for features, limits, leaves in zip(self.features, self.limits, self.leaves):
            node = np.zeros(len(rows), dtype=np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (rows[every, features[node]] > limits[node])
            found += leaves[node - inner]
        return found


def fit(
    rows: np.ndarray, labels: np.ndarray, trees: int = 50, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 2.0
) -> Boosted:
    """Second-order boosting of the logistic loss, on sums over at most ``bins`` bins of each feature.

    All nodes of a level get their sums at once. Features of zeros and ones have just the sums over
    their ones.
    """
    flags = np.flatnonzero(((rows == 0) | (rows == 1)).all(axis=0))
    numbers = np.setdiff1d(np.arange(rows.shape[1]), flags)
    flag_owner, flag = np.nonzero(rows[:, flags])
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in numbers]
    binned = np.stack([np.searchsorted(e, rows[:, j]) + i * bins for i, (e, j) in enumerate(zip(edges, numbers))], axis=1)
    width, inner = len(numbers) * bins, 2**depth - 1

    def sums(node: np.ndarray, nodes: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each node what lies left of each limit, of the numbers' bins and then of the flags, and
        all there is."""
        total = np.bincount(node, values, nodes)[:, None]
        place = node[:, None] * width + binned
        below = np.bincount(place.ravel(), np.repeat(values, len(numbers)), nodes * width)
        ones = np.bincount(node[flag_owner] * len(flags) + flag, values[flag_owner], nodes * len(flags))
        below = below.reshape(nodes, len(numbers), bins).cumsum(axis=2).reshape(nodes, width)
        return np.hstack([below, total - ones.reshape(nodes, len(flags))]), total

    share = np.clip(labels.mean(), 0.01, 0.99)
    model = Boosted(float(np.log(share / (1 - share))), np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    margin, every = np.full(len(rows), model.start), np.arange(len(rows))
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-margin))
        slope, curve = chance - labels, np.maximum(chance * (1 - chance), 1e-6)
        features, limits = np.zeros(inner, dtype=int), np.full(inner, np.inf)
        node = np.zeros(len(rows), dtype=np.int64)
        for level in range(depth):
            nodes, first = 2**level, 2**level - 1
            down, all_down = sums(node - first, nodes, slope)
            bend, all_bend = sums(node - first, nodes, curve)
            gain = down**2 / (bend + ridge) + (all_down - down) ** 2 / (all_bend - bend + ridge)
            gain[(bend < 1) | (all_bend - bend < 1)] = -np.inf
            for k, best in enumerate(np.argmax(gain, axis=1)):
                if gain[k, best] <= all_down[k, 0] ** 2 / (all_bend[k, 0] + ridge) + 1e-3:
                    continue
                if best < width:
                    features[first + k], limits[first + k] = numbers[best // bins], edges[best // bins][best % bins]
                else:
                    features[first + k], limits[first + k] = flags[best - width], 0.5
            node = 2 * node + 1 + (rows[every, features[node]] > limits[node])
        leaf = node - inner
        leaves = -rate * np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, curve, inner + 1) + ridge)
        margin += leaves[leaf]
        model.features = np.vstack([model.features, features])
        model.limits = np.vstack([model.limits, limits])
        model.leaves = np.vstack([model.leaves, leaves])
    return model
