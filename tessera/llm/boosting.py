"""Gradient-boosted trees with binned features, and isotonic calibration, in numpy."""

from __future__ import annotations

import numpy as np

BINS = 48


class BoostedTrees:
    """Logistic loss, trees of fixed depth; a tree is arrays of features and thresholds by level order."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.15, least: float = 4.0, ridge: float = 1.0):
        self.n_trees, self.depth, self.rate, self.least, self.ridge = trees, depth, rate, least, ridge
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        rate = (y.sum() + 0.5) / (len(y) + 1)
        self.base = float(np.log(rate / (1 - rate)))
        if len(y) < 2 or y.min() == y.max():
            return self
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, side="right") for c, v in zip(cuts, x.T, strict=True)])
        raw = np.full(len(y), self.base)
        for _ in range(self.n_trees):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = y - p, p * (1 - p)
            feature = np.zeros(2**self.depth - 1, dtype=np.int64)
            limit = np.full(2**self.depth - 1, np.inf)
            node = np.zeros(len(y), dtype=np.int64)
            for level in range(self.depth):
                first, n = 2**level - 1, 2**level
                best = np.zeros(n)
                at = node - first
                for f, cut in enumerate(cuts):
                    if not len(cut):
                        continue
                    g, h = (np.bincount(at * (BINS + 1) + binned[f], w, n * (BINS + 1)).reshape(n, -1).cumsum(axis=1) for w in (grad, hess))
                    gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                    gain = gl**2 / (hl + self.ridge) + (gt - gl) ** 2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
                    gain = np.where((hl >= self.least * 0.05) & (ht - hl >= self.least * 0.05), gain, 0)[:, : len(cut)]
                    k = gain.argmax(axis=1)
                    better = gain[np.arange(n), k] > best + 1e-9
                    best = np.where(better, gain[np.arange(n), k], best)
                    feature[first : first + n] = np.where(better, f, feature[first : first + n])
                    limit[first : first + n] = np.where(better, cut[k], limit[first : first + n])
                node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] >= limit[node])
            leaf = node - (2**self.depth - 1)
            g, h = (np.bincount(leaf, w, 2**self.depth) for w in (grad, hess))
            value = self.rate * g / (h + self.ridge)
            self.trees.append((feature, limit, value))
            raw += value[leaf]
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, limit, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] >= limit[node])
            out += value[node - (2**self.depth - 1)]
        return out


def isotonic(raw: np.ndarray, y: np.ndarray, prior: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: (places, values) to interpolate; a block's value is shrunk by `prior` rows of its own raw rate."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []
    for r, t in zip(raw[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([t, 1.0, r, r])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n, _, hi = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2], hi]
    places, values = [], []
    for s, n, lo, hi in blocks:
        middle = 1 / (1 + np.exp(-(lo + hi) / 2))
        v = (s + prior * middle) / (n + prior)
        places += [lo, hi]
        values += [v, v]
    return np.array(places), np.maximum.accumulate(np.array(values)) if values else np.array([])


def calibrated(raw: np.ndarray, places: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(places):
        return 1 / (1 + np.exp(-raw))
    return np.clip(np.interp(raw, places, values), 0.0, 1.0)
