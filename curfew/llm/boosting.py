"""Gradient-boosted trees in NumPy, kept as flat node arrays.

Trees are grown level by level on binned features for the logistic loss. For a
feature marked +1 (-1) the score never falls (rises) as it grows: a split that would
break this is not made, and the values below a split stay on their side of its
middle.
"""

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Trees:
    """Nodes of all trees, a fixed number per tree. A leaf leads to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of ``x``."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for tree in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                low = x[rows, self.feature[tree][node]] <= self.threshold[tree][node]
                node = np.where(low, self.left[tree][node], self.right[tree][node])
            total += self.value[tree][node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def bin_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Cuts between the quantiles of each feature."""
    out = []
    for column in x.T:
        distinct = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="nearest"))
        out.append((distinct[1:] + distinct[:-1]) / 2)
    return out


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 60, depth: int = 4, rate: float = 0.2,
        ridge: float = 1.0, least: int = 8) -> Trees:
    """Trees for the log-odds of ``y`` = 1."""
    rows, features = x.shape
    edges = bin_edges(x)
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    size = 2 ** (depth + 1) - 1
    shape = (trees, size)
    feature, threshold = np.zeros(shape, np.int64), np.full(shape, np.inf)
    left = np.tile(np.arange(size), (trees, 1))
    right, value = left.copy(), np.zeros(shape)
    margin = np.full(rows, base)
    offset = np.arange(features) * BINS
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = y - p, p * (1 - p)
        node = np.zeros(rows, np.int64)
        bounds = {0: (-np.inf, np.inf)}
        for level in range(depth + 1):
            first, count = 2**level - 1, 2**level
            at = node - first
            live = at >= 0
            key = (at[live, None] * features * BINS + offset + binned[live]).ravel()
            length = count * features * BINS
            sums = [
                np.bincount(key, np.repeat(v[live], features), length).reshape(count, features, BINS)
                for v in (gradient, hessian, np.ones(rows))
            ]
            for k in range(count):
                here = first + k
                if here not in bounds:
                    continue
                low, high = bounds[here]
                g, h, n = (s[k] for s in sums)
                total_g, total_h = g[0].sum(), h[0].sum()
                value[t, here] = np.clip(total_g / (total_h + ridge), low, high)
                if level == depth:
                    continue
                gl, hl, nl = (np.cumsum(s, 1)[:, :-1] for s in (g, h, n))
                gr, hr, nr = total_g - gl, total_h - hl, n[0].sum() - nl
                vl, vr = (np.clip(a / (b + ridge), low, high) for a, b in ((gl, hl), (gr, hr)))
                gain = gl * vl - (hl + ridge) * vl**2 / 2 + gr * vr - (hr + ridge) * vr**2 / 2
                gain -= total_g * value[t, here] - (total_h + ridge) * value[t, here] ** 2 / 2
                sign = np.array(monotone)[:, None]
                allowed = (nl >= least) & (nr >= least) & ((sign == 0) | (sign * (vr - vl) >= 0))
                gain = np.where(allowed, gain, -np.inf)
                best = int(np.argmax(gain))
                if not gain.flat[best] > 1e-6:
                    continue
                f, b = divmod(best, BINS - 1)
                if b >= len(edges[f]):
                    continue
                feature[t, here], threshold[t, here] = f, edges[f][b]
                left[t, here], right[t, here] = 2 * here + 1, 2 * here + 2
                middle = (vl[f, b] + vr[f, b]) / 2
                below, above = (low, middle), (middle, high)
                if monotone[f] < 0:
                    below, above = (middle, high), (low, middle)
                elif not monotone[f]:
                    below = above = (low, high)
                bounds[2 * here + 1], bounds[2 * here + 2] = below, above
                mine = node == here
                node[mine] = np.where(binned[mine, f] <= b, 2 * here + 1, 2 * here + 2)
        value[t] *= rate
        margin += value[t][node]
    return Trees(feature, threshold, left, right, value, depth, base)
