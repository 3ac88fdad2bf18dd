"""Gradient-boosted trees in numpy: histogram splits, monotonic constraints, and scoring over flat node arrays.

Small models only: the rows to fit are a bounded sample, the rows to score are all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Forest:
    """All trees in five flat arrays. A leaf's feature is -1; children lie at ``left`` and ``left + 1``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the positive class of each row of ``x``; every step moves all rows of all trees at once."""
        x = np.asarray(x, np.float64)
        if len(x) == 0:
            return np.zeros(0)
        rows = np.arange(len(x))[:, None]
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        while True:
            f = self.feature[node]
            inner = f >= 0
            if not inner.any():
                break
            right = x[rows, np.maximum(f, 0)] > self.cut[node]
            node = np.where(inner, self.left[node] + right, node)
        raw = self.base + self.value[node].sum(1)
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 40, depth: int = 3, rate: float = 0.2, least: float = 1.0, weight: np.ndarray | None = None) -> Forest:
    """Logistic boosting. ``monotone`` has +1, 0 or -1 per feature: the score may only rise, do anything, or only fall with it.

    Missing values are not expected. With one class only, the forest is a constant.
    """
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    w = np.ones(len(y)) if weight is None else np.asarray(weight, np.float64)
    feature, cut, left, value, roots = [], [], [], [], []
    p = np.clip((w * y).sum() / max(w.sum(), 1e-9), 1e-4, 1 - 1e-4) if len(y) else 0.5
    base = float(np.log(p / (1 - p)))
    raw = np.full(len(y), base)
    edges, codes = [], np.zeros(x.shape, np.int64)
    for j in range(x.shape[1] if len(y) else 0):
        e = np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]))
        edges.append(e)
        codes[:, j] = np.searchsorted(e, x[:, j], "left")

    def node() -> int:
        feature.append(-1), cut.append(0.0), left.append(0), value.append(0.0)
        return len(feature) - 1

    def grow(at: int, rows: np.ndarray, level: int, low: float, high: float) -> None:
        g, h = grad[rows], hess[rows]
        total_g, total_h = g.sum(), h.sum()
        best = (1e-6, -1, 0, 0.0, 0.0)
        if level < depth and len(rows) > 1:
            for j in range(x.shape[1]):
                n = len(edges[j]) + 1
                if n < 2:
                    continue
                c = codes[rows, j]
                gl = np.cumsum(np.bincount(c, g, n))[:-1]
                hl = np.cumsum(np.bincount(c, h, n))[:-1]
                gr, hr = total_g - gl, total_h - hl
                vl, vr = np.clip(-gl / (hl + 1), low, high), np.clip(-gr / (hr + 1), low, high)
                # The loss of the leaves as they would be clipped, so that a constraint is paid for in the gain.
                gain = -(gl * vl + 0.5 * (hl + 1) * vl**2) - (gr * vr + 0.5 * (hr + 1) * vr**2)
                ok = (hl >= least) & (hr >= least)
                if monotone[j]:
                    ok &= (vr - vl) * monotone[j] >= 0
                gain = np.where(ok, gain, -np.inf)
                k = int(gain.argmax())
                if gain[k] > -np.inf and gain[k] - 0.5 * total_g**2 / (total_h + 1) > best[0]:
                    best = (gain[k] - 0.5 * total_g**2 / (total_h + 1), j, k, float(vl[k]), float(vr[k]))
        if best[1] < 0:
            value[at] = rate * float(np.clip(-total_g / (total_h + 1), low, high))
            raw[rows] += value[at]
            return
        _, j, k, vl, vr = best
        a, b = node(), node()
        feature[at], cut[at], left[at] = j, float(edges[j][k]), a
        middle = (vl + vr) / 2
        bounds = ((low, high), (low, high)) if not monotone[j] else ((low, middle), (middle, high)) if monotone[j] > 0 else ((middle, high), (low, middle))
        right = codes[rows, j] > k
        grow(a, rows[~right], level + 1, *bounds[0])
        grow(b, rows[right], level + 1, *bounds[1])

    for _ in range(trees if len(y) and 0 < y.sum() < len(y) else 0):
        q = 1 / (1 + np.exp(-raw))
        grad, hess = w * (q - y), np.maximum(w * q * (1 - q), 1e-9)
        roots.append(node())
        grow(roots[-1], np.arange(len(y)), 0, -8.0, 8.0)
    if not roots:
        roots.append(node())
    return Forest(np.array(feature), np.array(cut), np.array(left), np.array(value), np.array(roots), base)
