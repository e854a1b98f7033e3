"""Gradient-boosted trees for small tables of numbers, with calibrated scores."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

TREES, DEPTH, RATE, LEAST_LEAF, BINS = 60, 3, 0.2, 5.0, 32


class Tree(NamedTuple):
    """A full binary tree as arrays: node k has children 2k + 1 and 2k + 2."""

    feature: np.ndarray  #: -1: leaf
    cut: np.ndarray
    value: np.ndarray


class Model(NamedTuple):
    start: float
    trees: list[Tree]
    slope: float  #: of the calibration: sigmoid(slope * score + shift)
    shift: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for tree in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                feature = tree.feature[node]
                right = x[np.arange(len(x)), np.maximum(feature, 0)] > tree.cut[node]
                node = np.where(feature < 0, node, 2 * node + 1 + right)
            total += RATE * tree.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.score(x) + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _grow(x: np.ndarray, bins: list[np.ndarray], codes: np.ndarray, grad: np.ndarray, weight: np.ndarray) -> Tree:
    size = 2 ** (DEPTH + 1) - 1
    feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
    rows = {0: np.arange(len(x))}
    for node in range(size):
        mine = rows.pop(node, None)
        if mine is None:
            continue
        g, h = grad[mine].sum(), weight[mine].sum()
        value[node] = g / (h + 1)
        if node >= 2**DEPTH - 1:
            continue
        best = (1e-6, -1, 0)
        for f in range(x.shape[1]):
            code = codes[mine, f]
            left_g = np.cumsum(np.bincount(code, grad[mine], BINS + 1))[:-1]
            left_h = np.cumsum(np.bincount(code, weight[mine], BINS + 1))[:-1]
            n = np.cumsum(np.bincount(code, minlength=BINS + 1))[:-1]
            gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g * g / (h + 1)
            gain[(n < LEAST_LEAF) | (len(mine) - n < LEAST_LEAF)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0] and k < len(bins[f]):
                best = (float(gain[k]), f, k)
        if best[1] >= 0:
            _, f, k = best
            feature[node], cut[node] = f, bins[f][k]
            right = codes[mine, f] > k
            rows[2 * node + 1], rows[2 * node + 2] = mine[~right], mine[right]
    return Tree(feature, cut, value)


def fit(x: np.ndarray, y: np.ndarray, held: np.ndarray) -> Model:
    """Boost on the rows not ``held``; calibrate the scores on the held ones (Platt)."""
    train, goal = x[~held], y[~held].astype(float)
    bins = [np.unique(np.quantile(train[:, f], np.linspace(0, 1, BINS)))[:-1] for f in range(x.shape[1])]
    codes = np.column_stack([np.searchsorted(b, train[:, f], side="left") for f, b in enumerate(bins)])
    rate = min(max(goal.mean(), 1e-3), 1 - 1e-3)
    model = Model(float(np.log(rate / (1 - rate))), [], 1.0, 0.0)
    total = np.full(len(train), model.start)
    for _ in range(TREES):
        p = _sigmoid(total)
        tree = _grow(train, bins, codes, goal - p, p * (1 - p))
        model.trees.append(tree)
        total += Model(0.0, [tree], 1.0, 0.0).score(train)
    return _calibrated(model, x[held], y[held].astype(float))


def _calibrated(model: Model, x: np.ndarray, y: np.ndarray) -> Model:
    if not len(y) or y.min() == y.max():
        return model
    score, a, b = model.score(x), 1.0, 0.0
    # Smoothed goals keep the slope finite when the classes part completely.
    up, down = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    goal = np.where(y > 0, up, down)
    for _ in range(50):
        p = _sigmoid(a * score + b)
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((goal - p) * score).sum(), (goal - p).sum()])
        h = np.array([[(w * score * score).sum() + 1e-6, (w * score).sum()], [(w * score).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return model._replace(slope=float(a), shift=float(b))
