"""Gradient-boosted trees for yes or no, on binned features: small, exact to rerun, numpy only."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Trees:
    """Complete trees of one depth: feature and cut [trees, inner nodes], value [trees, leaves]; base log-odds."""

    depth: int
    base: float
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)

    def tree(self, x: np.ndarray, k: int) -> np.ndarray:
        """What tree k adds for each row."""
        return self._grown(np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1], k)

    def _grown(self, flat: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
        feature, cut = self.feature[k], self.cut[k]
        at = (flat[rows + feature[0]] > cut[0]) + 1
        for _ in range(self.depth - 1):
            right = flat[rows + feature[at]] > cut[at]
            at += at
            at += 1
            at += right
        return self.value[k][at - ((1 << self.depth) - 1)]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        flat, rows = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        for k in range(len(self.value)):
            out += self._grown(flat, rows, k)
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, least: float = 20.0, shrink: float = 1.0, share: float = 1.0, seed: int = 3) -> Trees:
    """Newton boosting of the logistic loss; a split needs `least` rows on each side, else it sends all to the left.

    share: of the rows, drawn anew by seed, from which each tree is grown.
    """
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    mean = (y.sum() + 1) / (len(y) + 2)
    model = Trees(depth, float(np.log(mean / (1 - mean))))
    score = np.full(len(y), model.base)
    drawn = np.random.default_rng(seed)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        rows = np.flatnonzero(drawn.random(len(y)) < share) if share < 1 else np.arange(len(y))
        own, bins = x[rows], binned[:, rows]
        g, h, ones = (y - p)[rows], (p * (1 - p))[rows], np.ones(len(rows))
        feature, cut = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, np.inf)
        at = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.zeros(width)
            place = at - first
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                key = place * (len(e) + 1) + bins[f]
                gs, hs, ns = (np.bincount(key, weights=w, minlength=width * (len(e) + 1)).reshape(width, -1) for w in (g, h, ones))
                gl, hl, nl = (np.cumsum(a, axis=1)[:, :-1] for a in (gs, hs, ns))
                gt, ht, nt = (a.sum(axis=1, keepdims=True) for a in (gs, hs, ns))
                gain = gl**2 / (hl + shrink) + (gt - gl) ** 2 / (ht - hl + shrink) - gt**2 / (ht + shrink)
                gain[(nl < least) | (nt - nl < least)] = -1
                k = gain.argmax(axis=1)
                top = gain[np.arange(width), k]
                for n in np.flatnonzero(top > best + 1e-9):
                    best[n], feature[first + n], cut[first + n] = top[n], f, e[k[n]]
            at = 2 * at + 1 + (own[np.arange(len(rows)), feature[at]] > cut[at])
        leaf = at - (1 << depth) + 1
        gs, hs = (np.bincount(leaf, weights=w, minlength=1 << depth) for w in (g, h))
        model.feature.append(feature)
        model.cut.append(cut)
        model.value.append(rate * gs / (hs + shrink))
        score += model.tree(x, -1)
    return model
