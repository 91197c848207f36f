"""Gradient-boosted trees on histograms, with monotonic constraints.

Trees have a fixed depth and are kept flat: ``feature``, ``threshold`` and
``value`` arrays of one row per tree, node k's children at 2k + 1 and 2k + 2.
Scoring walks all rows down a level at a time. A constraint of +1 (-1) on a
feature refuses splits that lower (raise) the score to the right, and passes
the middle of the two sides' values down as bounds, so that the whole model is
monotone in the feature."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; go right if x > threshold
    value: np.ndarray  # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds for each row of ``x``."""
        inner = self.feature.shape[1]
        rows = np.arange(len(x))
        out = np.full(len(x), self.base)
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            while inner and node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - inner]
        return out


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2,
        bins: int = 64, ridge: float = 1.0, least: int = 4) -> Forest:
    """Binary log-loss boosting; ``y`` in {0, 1}; ``least`` is the smallest
    number of rows on a side of a split. With a single class, or no
    rows, the model is a constant."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    share = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Forest(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    n, k = binned.shape
    cell = binned + np.arange(k) * bins
    margin = np.full(n, base)
    parts: dict[str, list] = {"feature": [], "threshold": [], "value": []}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        low, high = np.full(inner + leaves, -np.inf), np.full(inner + leaves, np.inf)
        value = np.zeros(inner + leaves)
        node = np.zeros(n, dtype=np.int64)
        for at in range(inner):
            mine = np.flatnonzero(node == at)
            left, right = 2 * at + 1, 2 * at + 2
            low[[left, right]], high[[left, right]] = low[at], high[at]
            value[[left, right]] = value[at]
            if not len(mine):
                continue
            weight = [np.bincount(cell[mine].ravel(), np.repeat(v[mine], k), k * bins).reshape(k, bins).cumsum(axis=1)
                      for v in (grad, hess, np.ones(n))]
            gl, hl, nl = (w[:, :-1] for w in weight)
            gr, hr, nr = (w[:, -1:] - w[:, :-1] for w in weight)
            vl = np.clip(gl / (hl + ridge), low[at], high[at])
            vr = np.clip(gr / (hr + ridge), low[at], high[at])
            gain = (2 * gl * vl - (hl + ridge) * vl ** 2) + (2 * gr * vr - (hr + ridge) * vr ** 2)
            whole_g, whole_h = grad[mine].sum(), hess[mine].sum() + ridge
            own = np.clip(whole_g / whole_h, low[at], high[at])
            gain -= 2 * whole_g * own - whole_h * own ** 2
            usable = (np.arange(bins - 1) < np.array([len(e) for e in edges])[:, None]) & (nl >= least) & (nr >= least)
            usable &= monotone[:, None] * (vr - vl) >= 0
            gain = np.where(usable, gain, -np.inf)
            best = int(gain.argmax())
            f, b = divmod(best, bins - 1)
            if at == 0:
                value[0] = own
            if not gain[f, b] > 1e-9:
                value[[left, right]] = value[at] = own
                node[mine] = left
                continue
            feature[at], threshold[at] = f, edges[f][b]
            value[left], value[right] = vl[f, b], vr[f, b]
            if monotone[f]:
                middle = (vl[f, b] + vr[f, b]) / 2
                (high if monotone[f] > 0 else low)[left] = middle
                (low if monotone[f] > 0 else high)[right] = middle
            node[mine] = np.where(binned[mine, f] > b, right, left)
        margin += rate * value[node]
        parts["feature"].append(feature)
        parts["threshold"].append(threshold)
        parts["value"].append(rate * value[inner:])
    return Forest(*(np.array(parts[key]) for key in ("feature", "threshold", "value")), base)
