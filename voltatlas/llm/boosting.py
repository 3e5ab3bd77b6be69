"""Small gradient boosted trees for a bounded training table: logistic loss, histogram splits, numpy only."""

from __future__ import annotations

import numpy as np


def fit_trees(x: np.ndarray, y: np.ndarray, n_trees: int = 40, depth: int = 3, rate: float = 0.3,
              l2: float = 1.0) -> tuple[float, list]:
    """Start value and trees; a tree holds for each inner node a column and a cut, then the leaf values."""
    mean = min(max(float(y.mean()), 1e-4), 1 - 1e-4)
    start = float(np.log(mean / (1 - mean)))
    margin = np.full(len(y), start)
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, 33)[1:-1], method="lower")) for column in x.T]
    trees = []
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        grad, weight = y - p, p * (1 - p)
        columns, values = np.zeros(2 ** depth - 1, int), np.full(2 ** depth - 1, np.inf)
        node = np.zeros(len(y), int)
        for inner in range(2 ** depth - 1):
            rows = np.flatnonzero(node == inner)
            if len(rows):
                columns[inner], values[inner] = best_split(x[rows], grad[rows], weight[rows], cuts, l2)
                node[rows] = 2 * inner + 1 + (x[rows, columns[inner]] > values[inner])
        leaf = node - (2 ** depth - 1)
        top = np.bincount(leaf, grad, 2 ** depth)
        leaves = rate * top / (np.bincount(leaf, weight, 2 ** depth) + l2)
        margin += leaves[leaf]
        trees.append((columns, values, leaves))
    return start, trees


def best_split(x: np.ndarray, grad: np.ndarray, weight: np.ndarray, cuts: list, l2: float) -> tuple[int, float]:
    """Column and cut of the greatest gain; the lowest column and cut of equal ones. A node that no cut betters sends all left."""
    g, h = grad.sum(), weight.sum()
    best = (1e-9, 0, np.inf)
    for column, points in enumerate(cuts):
        if len(points):
            bins = np.searchsorted(points, x[:, column], side="left")  # bin n: at most points[n]
            left_g = np.cumsum(np.bincount(bins, grad, len(points) + 1))[:-1]
            left_h = np.cumsum(np.bincount(bins, weight, len(points) + 1))[:-1]
            gain = left_g ** 2 / (left_h + l2) + (g - left_g) ** 2 / (h - left_h + l2) - g ** 2 / (h + l2)
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (gain[at], column, points[at])
    return best[1], best[2]


def margins(model: tuple[float, list], x: np.ndarray) -> np.ndarray:
    start, trees = model
    total = np.full(len(x), start)
    for columns, values, leaves in trees:
        node = np.zeros(len(x), int)
        while len(x) and node[0] < len(columns):
            node = 2 * node + 1 + (x[np.arange(len(x)), columns[node]] > values[node])
        if len(x):
            total += leaves[node - len(columns)]
    return total
