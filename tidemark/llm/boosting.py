"""Gradient-boosted trees and isotonic calibration on small dense matrices, in numpy."""

from __future__ import annotations

import numpy as np


def quantile_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(c) else c for c in x.T]


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin b holds edges[b-1] < v <= edges[b]."""
    return np.stack([np.searchsorted(e, c, side="left") for c, e in zip(x.T, edges, strict=True)], axis=1).astype(np.int16)


class Boosted:
    """Depth-limited trees on binned features under logistic loss. ``trees``: per tree arrays (feature, bin, value) in heap order."""

    def __init__(self, edges: list[np.ndarray], base: float, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.edges, self.base, self.trees = edges, base, trees

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 2.0) -> "Boosted":
        weight = np.ones(len(y)) if weight is None else weight
        edges = quantile_edges(x, bins)
        b = to_bins(x, edges).astype(np.int64)
        width = max([len(e) for e in edges], default=0) + 1
        mean = np.clip(np.average(y, weights=weight) if len(y) else 0.5, 1e-3, 1 - 1e-3)
        base = float(np.log(mean / (1 - mean)))
        f, made = np.full(len(y), base), []
        flat = b + np.arange(b.shape[1]) * width if len(y) else b
        for _ in range(trees if 0 < mean < 1 and len(y) else 0):
            p = 1 / (1 + np.exp(-f))
            g, h = (y - p) * weight, np.maximum(p * (1 - p), 1e-6) * weight
            feature, cut, value = np.full(2**depth - 1, -1), np.zeros(2**depth - 1, int), np.zeros(2 ** (depth + 1) - 1)
            node = np.zeros(len(y), int)
            for k in range(2 ** (depth + 1) - 1):
                mine = np.flatnonzero(node == k)
                if not len(mine):
                    continue
                sg, sh = g[mine].sum(), h[mine].sum()
                value[k] = rate * sg / (sh + l2)
                if k >= len(feature) or len(mine) < 10:
                    continue
                at = flat[mine].ravel()
                hg = np.bincount(at, np.repeat(g[mine], b.shape[1]), width * b.shape[1]).reshape(b.shape[1], width).cumsum(1)
                hh = np.bincount(at, np.repeat(h[mine], b.shape[1]), width * b.shape[1]).reshape(b.shape[1], width).cumsum(1)
                gain = hg**2 / (hh + l2) + (sg - hg) ** 2 / (sh - hh + l2) - sg**2 / (sh + l2)
                gain[(hh < 0.2) | (sh - hh < 0.2)] = -1
                best = int(gain.argmax())
                if gain.flat[best] > 1e-4:
                    feature[k], cut[k] = divmod(best, width)
                    node[mine] = 2 * k + 1 + (b[mine, feature[k]] > cut[k])
            made.append((feature, cut, value))
            f = f + value[node]
        return cls(edges, base, made)

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, f = to_bins(x, self.edges), np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(int(np.log2(len(feature) + 1))):
                inner = node < len(feature)
                split = inner & (feature[np.minimum(node, len(feature) - 1)] >= 0)
                at = node[split]
                node[split] = 2 * at + 1 + (b[rows[split], feature[at]] > cut[at])
            f += value[node]
        return f


class Isotonic:
    """Pool-adjacent-violators on (score, label, weight), smoothed towards the mean by one pseudo-row; linear between blocks."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None):
        weight = np.ones(len(y)) if weight is None else weight
        order = np.argsort(x, kind="stable")
        blocks: list[list[float]] = []  # sum of labels, rows, first, last
        mean = float(np.average(y, weights=weight)) if len(y) else 0.5
        for v, label, w in zip(x[order], y[order], weight[order], strict=True):
            blocks.append([float(label * w), float(w), float(v), float(v)])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                s, n, _, last = blocks.pop()
                blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2], last]
        level = np.maximum.accumulate([(s + mean) / (n + 1) for s, n, _, _ in blocks]) if blocks else np.array([])
        self.at = np.array([v for _, _, a, z in blocks for v in (a, z)]) if blocks else np.array([0.0])
        self.level = np.repeat(level, 2) if blocks else np.array([mean])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(x, self.at, self.level), 0, 1)
