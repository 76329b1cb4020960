"""Gradient-boosted trees in numpy: logistic loss, histograms, and monotonic constraints on chosen features.

A fitted model is flat arrays of nodes, which score many rows at once: each step moves every (row, tree) pair one
level down. A leaf points at itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Node arrays of all trees end to end; roots has the first node of each tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray, block: int = 4096) -> np.ndarray:
        out = np.full(len(x), self.base)
        for start in range(0, len(x) if len(self.roots) else 0, block):
            part = x[start : start + block]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            rows = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                node = np.where(part[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out[start : start + block] += self.value[node].sum(axis=1)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -35, 35)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: dict[int, int] | None = None,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    l2: float = 1.0,
    least: int = 5,
) -> Trees:
    """`monotone` maps a feature to +1 or -1: the score never falls, or never rises, as it grows. A split that would
    put its children's values the wrong way round is passed over, and their middle bounds what lies below each."""
    x, y = np.asarray(x, dtype=np.float64), np.asarray(y, dtype=np.float64)
    monotone = monotone or {}
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(y) else np.zeros(0) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1) if len(y) else np.zeros(x.shape, dtype=int)

    def node() -> int:
        for array, item in ((feature, 0), (threshold, np.inf), (left, len(feature)), (right, len(feature)), (value, 0.0)):
            array.append(item)
        return len(feature) - 1

    def best_split(rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple | None:
        total_g, total_h, best = g[rows].sum(), h[rows].sum(), None
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            size = len(c) + 1
            at = binned[rows, f]
            gl, hl, nl = (np.cumsum(np.bincount(at, weights=w, minlength=size))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
            gr, hr = total_g - gl, total_h - hl
            gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - total_g**2 / (total_h + l2)
            allowed = (nl >= least) & (len(rows) - nl >= least)
            if f in monotone:
                allowed &= monotone[f] * (-gr / (hr + l2) + gl / (hl + l2)) >= 0
            gain = np.where(allowed, gain, -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                best = (gain[k], f, k, -gl[k] / (hl[k] + l2), -gr[k] / (hr[k] + l2))
        return best

    def grow(at: int, rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float, levels: int) -> None:
        found = best_split(rows, g, h) if levels else None
        if not found:
            value[at] = rate * float(np.clip(-g[rows].sum() / (h[rows].sum() + l2), low, high))
            return
        _, f, k, vl, vr = found
        feature[at], threshold[at] = f, float(cuts[f][k])
        left[at], right[at] = node(), node()
        goes = binned[rows, f] <= k
        middle = float(np.clip((vl + vr) / 2, low, high))
        bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}.get(monotone.get(f, 0), ((low, high), (low, high)))
        grow(left[at], rows[goes], g, h, *bounds[0], levels - 1)
        grow(right[at], rows[~goes], g, h, *bounds[1], levels - 1)

    def flat() -> Trees:
        return Trees(np.array(feature, dtype=np.int64), np.array(threshold), np.array(left, dtype=np.int64), np.array(right, dtype=np.int64), np.array(value), np.array(roots, dtype=np.int64), base, depth)

    margin = np.full(len(y), base)
    for _ in range(trees if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-margin))
        roots.append(node())
        grow(roots[-1], np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-6), -np.inf, np.inf, depth)
        own = flat()
        margin += Trees(own.feature, own.threshold, own.left, own.right, own.value, own.roots[-1:], 0.0, depth).margin(x)
    return flat()
