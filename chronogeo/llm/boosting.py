"""Gradient-boosted regression trees for two classes, in numpy, with histogram splits."""

from __future__ import annotations

import numpy as np


class Boosted:
    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0, least: int = 8):
        self.n, self.depth, self.rate, self.bins, self.ridge, self.least = trees, depth, rate, bins, ridge, least
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        n, d = x.shape
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(d)]
        code = self._code(x)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        f = np.full(n, self.base)
        size = (1 << (self.depth + 1)) - 1
        for _ in range(self.n):
            q = 1 / (1 + np.exp(-f))
            g, h = y - q, q * (1 - q)
            feat, cut, value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
            node = np.zeros(n, np.int64)
            for k in range(size):
                rows = np.flatnonzero(node == k)
                if not len(rows):
                    continue
                gs, hs = g[rows].sum(), h[rows].sum()
                value[k] = self.rate * gs / (hs + self.ridge)
                if k >= size // 2 or len(rows) < 2 * self.least:
                    continue
                best = (1e-6, -1, 0)
                for j in range(d):
                    c, m = code[rows, j], len(self.edges[j]) + 1
                    if m < 2:
                        continue
                    gl, hl = np.cumsum(np.bincount(c, g[rows], m))[:-1], np.cumsum(np.bincount(c, h[rows], m))[:-1]
                    nl = np.cumsum(np.bincount(c, minlength=m))[:-1]
                    gain = gl**2 / (hl + self.ridge) + (gs - gl) ** 2 / (hs - hl + self.ridge) - gs**2 / (hs + self.ridge)
                    gain[(nl < self.least) | (len(rows) - nl < self.least)] = 0
                    b = int(gain.argmax())
                    if gain[b] > best[0]:
                        best = (gain[b], j, b)
                if best[1] >= 0:
                    feat[k], cut[k] = best[1], best[2]
                    node[rows] = 2 * k + 1 + (code[rows, best[1]] > best[2])
            self.trees.append((feat, cut, value))
            f += value[node]
        return self

    def _code(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], 1)

    def decision(self, x: np.ndarray) -> np.ndarray:
        code, f, rows = self._code(x), np.full(len(x), self.base), np.arange(len(x))
        for feat, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                j = feat[node]
                node = np.where(j >= 0, 2 * node + 1 + (code[rows, np.maximum(j, 0)] > cut[node]), node)
            f += value[node]
        return f


def calibrate(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of Platt scaling, P = sigmoid(a f + b), by Newton steps with smoothed targets."""
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a * f + b, -30, 30)))
        w = np.maximum(q * (1 - q), 1e-6)
        r = t - q
        h = np.array([[(w * f * f).sum() + 1e-3, (w * f).sum()], [(w * f).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, [(r * f).sum(), r.sum()])
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-6:
            break
    return float(a), float(b)
