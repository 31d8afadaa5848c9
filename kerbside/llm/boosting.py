"""Gradient-boosted trees for a yes-or-no label, fitted and scored with NumPy.

All trees have the same shape in memory: node arrays of feature, threshold, children and value, one row per
tree. A row moves down all levels of a tree by array lookups, so a batch is scored without a loop over rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass(frozen=True)
class Forest:
    """Flattened trees; a node whose ``left`` is itself is a leaf."""

    feature: np.ndarray  # (trees, nodes) int
    threshold: np.ndarray  # (trees, nodes): to the left goes what is at most this
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[t, at]] <= self.threshold[t, at]
                at = np.where(goes_left, self.left[t, at], self.right[t, at])
            total += self.value[t, at]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: tuple[int, ...],
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    smooth: float = 1.0,
    least: float = 1.0,
) -> Forest:
    """Logistic boosting on binned features.

    ``monotone`` has a sign per feature: with 1 the score may only rise with the feature, with -1 only fall, 0
    leaves it free. A split that breaks its sign is not taken, and the values below a split stay on their side of
    the middle of its two halves, so the constraint holds for the whole forest. Without two classes the forest is
    the constant share of the labels.
    """
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    nodes = 2 ** (depth + 1) - 1
    feature, threshold = np.zeros((trees, nodes), np.int64), np.zeros((trees, nodes))
    left = np.tile(np.arange(nodes), (trees, 1))
    right, value = left.copy(), np.zeros((trees, nodes))
    if len(np.unique(y)) < 2:
        return Forest(feature[:0], threshold[:0], left[:0], right[:0], value[:0], depth, base)

    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)], axis=1)
    score = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = y - p, p * (1 - p)
        work = [(0, np.arange(len(y)), 0, -np.inf, np.inf)]
        while work:
            node, rows, level, low, high = work.pop()
            g, h = gradient[rows], weight[rows]
            own = float(np.clip(g.sum() / (h.sum() + smooth), low, high))
            value[t, node] = own * rate
            split = _best(binned[rows], g, h, monotone, smooth, least, low, high) if level < depth else None
            if split is None:
                score[rows] += value[t, node]
                continue
            j, cut, a, b = split
            feature[t, node], threshold[t, node] = j, cuts[j][cut]
            left[t, node], right[t, node] = 2 * node + 1, 2 * node + 2
            middle, to_left = (a + b) / 2, binned[rows, j] <= cut
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
            left_bounds, right_bounds = bounds.get(monotone[j], ((low, high), (low, high)))
            work += [
                (2 * node + 1, rows[to_left], level + 1, *left_bounds),
                (2 * node + 2, rows[~to_left], level + 1, *right_bounds),
            ]
    return Forest(feature, threshold, left, right, value, depth, base)


def _best(binned, g, h, monotone, smooth, least, low, high):
    """(feature, bin, left value, right value) of the split that gains most, or None."""
    all_g, all_h = g.sum(), h.sum()
    best, found = 1e-6 + all_g**2 / (all_h + smooth), None
    for j, sign in enumerate(monotone):
        left_g = np.cumsum(np.bincount(binned[:, j], g, BINS + 1))[:-1]
        left_h = np.cumsum(np.bincount(binned[:, j], h, BINS + 1))[:-1]
        right_g, right_h = all_g - left_g, all_h - left_h
        a = np.clip(left_g / (left_h + smooth), low, high)
        b = np.clip(right_g / (right_h + smooth), low, high)
        gain = 2 * (a * left_g + b * right_g) - a**2 * (left_h + smooth) - b**2 * (right_h + smooth)
        fits = (left_h >= least) & (right_h >= least) & (sign * (b - a) >= 0)
        gain = np.where(fits, gain, -np.inf)
        k = int(gain.argmax())
        if gain[k] > best:
            best, found = gain[k], (j, k, float(a[k]), float(b[k]))
    return found
