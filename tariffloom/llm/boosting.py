"""Gradient-boosted trees and isotonic calibration in numpy, for a bounded table of labelled rows."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 64


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Trees:
    """Complete binary trees of one depth; a node that isn't split sends every row to the left."""

    base: float
    depth: int
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    values: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in zip(self.features, self.cuts, self.values):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += value[at - (2 ** self.depth - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, ridge: float = 1.0,
              least: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss on quantile bins. ``least``: summed second derivative of a leaf."""
    mean = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    model = Trees(float(np.log(mean / (1 - mean))), depth)
    if len(y) == 0 or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], 1)
    margin, inner = np.full(len(y), model.base), 2 ** depth - 1
    for _ in range(trees):
        p = sigmoid(margin)
        grad, hess = p - y, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            for node in range(2 ** level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(at == node)
                found = best_split(binned[rows], grad[rows], hess[rows], edges, ridge, least)
                if found:
                    feature[node], k = found
                    cut[node] = edges[feature[node]][k]
                    at[rows] = 2 * node + 1 + (binned[rows, feature[node]] > k)
                else:
                    at[rows] = 2 * node + 1
        leaf = at - inner
        g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
        value = -rate * g / (h + ridge)
        margin += value[leaf]
        model.features.append(feature)
        model.cuts.append(cut)
        model.values.append(value)
    return model


def best_split(binned, grad, hess, edges, ridge: float, least: float) -> tuple[int, int] | None:
    best, where = 1e-9, None
    total_g, total_h = grad.sum(), hess.sum()
    for f, edge in enumerate(edges):
        if not len(edge):
            continue
        g = np.bincount(binned[:, f], grad, len(edge) + 1).cumsum()[:-1]
        h = np.bincount(binned[:, f], hess, len(edge) + 1).cumsum()[:-1]
        gain = g ** 2 / (h + ridge) + (total_g - g) ** 2 / (total_h - h + ridge) - total_g ** 2 / (total_h + ridge)
        gain[(h < least) | (total_h - h < least)] = 0
        k = int(gain.argmax())
        if gain[k] > best:
            best, where = gain[k], (f, k)
    return where


def fit_isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of a non-decreasing map of margins to probabilities, one prior row of each class."""
    if len(y) == 0:
        return np.array([0.0]), np.array([0.5])
    # rows of one margin are one point; a weak row of each class at the ends keeps probabilities off 0 and 1
    places, at = np.unique(margin, return_inverse=True)
    sums, weights = np.bincount(at, y).astype(float), np.bincount(at).astype(float)
    for end in (0, -1):
        sums[end] += 0.5
        weights[end] += 1
    blocks: list[list[float]] = []  # mean, weight, lowest, highest
    for m, v, w in zip(places.tolist(), (sums / weights).tolist(), weights.tolist()):
        blocks.append([v, w, m, m])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, _, high = blocks.pop()
            v1, w1, low, _ = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, low, high])
    knots = [(b[2], b[0]) for b in blocks] + [(b[3], b[0]) for b in blocks]
    knots.sort()
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


def calibrated(margin: np.ndarray, knots: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.interp(margin, *knots)
