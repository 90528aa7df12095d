"""Gradient-boosted trees of depth three over binned features, for small bounded training sets."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

DEPTH = 3


@dataclass
class Trees:
    """Full trees: per tree 7 splits (feature, bin) and 8 leaves; ``scale`` and ``shift`` calibrate the margin.

    ``threshold`` is the least probability at which the calibration rows were as precise as asked.
    """

    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 1.0

    def codes(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        if self.leaf and len(x):
            code = self.codes(x)
            for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
                total += leaf[_walk(code, feature, cut)]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.margin(x) + self.shift, -30, 30)))

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, precision: float) -> None:
        """Fit scale and shift on rows that the trees have not seen (Newton steps of a logistic fit, lightly held back), and set the threshold."""
        m = self.margin(x)
        a, b = 1.0, 0.0
        target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
            w = weight * p * (1 - p) + 1e-6
            g = np.array([(weight * (p - target) * m).sum() + 1e-2 * (a - 1), (weight * (p - target)).sum()])
            h = np.array([[(w * m * m).sum() + 1e-2, (w * m).sum()], [(w * m).sum(), w.sum()]])
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-8:
                break
        self.scale, self.shift = float(a), float(b)
        order = np.argsort(-m, kind="stable")
        right, all_ = np.cumsum((weight * y)[order]), np.cumsum(weight[order])
        # rows of one margin stand or fall together
        last = np.append(np.diff(m[order]) != 0, True)
        good = np.flatnonzero(last & (right >= precision * all_))
        self.threshold = float(self.probability(x[order[good[-1:]]])[0]) if len(good) else float("inf")


def _walk(code: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    node = np.zeros(len(code), np.int64)
    for _ in range(DEPTH):
        node = 2 * node + 1 + (code[np.arange(len(code)), feature[node]] >= cut[node])
    return node - (2**DEPTH - 1)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 40, rate: float = 0.2, bins: int = 24) -> Trees:
    """Trees for 0/1 labels of weighted rows."""
    model = Trees(float(np.log(((weight * y).sum() + 0.5) / ((weight * (1 - y)).sum() + 0.5))))
    model.edges = [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins)) for j in range(x.shape[1])]
    code = model.codes(x)
    width = max(map(len, model.edges)) + 1
    margin = np.full(len(y), model.start)
    inner, rows = 2**DEPTH - 1, np.arange(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        g, h = weight * (y - p), weight * p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, width, np.int64)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * x.shape[1] + np.arange(x.shape[1])) * width + code
            shape = count, x.shape[1], width
            sums = [np.bincount(cell.ravel(), np.repeat(v, x.shape[1]), count * x.shape[1] * width).reshape(shape) for v in (g, h)]
            left_g, left_h = (np.cumsum(s, axis=2)[:, :, :-1] for s in sums)
            all_g, all_h = (s.sum(axis=2)[:, :, None] for s in sums)
            gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
            best = gain.reshape(count, -1).argmax(axis=1)
            good = gain.reshape(count, -1).max(axis=1) > 1e-9
            feature[first : first + count] = best // (width - 1)
            cut[first : first + count] = np.where(good, best % (width - 1) + 1, width)
            node = 2 * node + 1 + (code[rows, feature[node]] >= cut[node])
        at = node - inner
        leaf = rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + 1)
        margin += leaf[at]
        model.feature.append(feature)
        model.cut.append(cut)
        model.leaf.append(leaf)
    return model
