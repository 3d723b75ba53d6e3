"""Gradient-boosted regression trees on histograms, for two classes."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """Nodes in level order; a leaf has feature -1."""

    feature: list[int] = field(default_factory=list)
    limit: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, x in ((self.feature, -1), (self.limit, 0.0), (self.left, 0), (self.right, 0), (self.value, value)):
            column.append(x)
        return len(self.feature) - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, limit, left, right, value = map(np.array, (self.feature, self.limit, self.left, self.right, self.value))
        at = np.zeros(len(x), np.int64)
        while len(inner := np.flatnonzero(feature[at] >= 0)):
            node = at[inner]
            at[inner] = np.where(x[inner, feature[node]] <= limit[node], left[node], right[node])
        return value[at]


@dataclass
class Boosted:
    base: float
    rate: float
    trees: list[Tree]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.base + self.rate * sum((t.predict(x) for t in self.trees), np.zeros(len(x)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, ridge: float = 1.0, least: int = 20) -> Boosted:
    """Fit by second-order boosting of the logistic loss; splits are searched
    among quantiles of each feature."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = Boosted(float(np.log(share / (1 - share))), rate, [])
    odds = np.full(len(y), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        g, h = p - y, p * (1 - p)
        tree = Tree()
        work = [(tree.add(0.0), np.arange(len(y)), 0)]
        while work:
            node, rows, level = work.pop()
            sum_g, sum_h = g[rows].sum(), h[rows].sum()
            tree.value[node] = float(-sum_g / (sum_h + ridge))
            if level == depth or len(rows) < 2 * least:
                continue
            best = (1e-6, -1, 0)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                own = code[rows, f]
                gl = np.cumsum(np.bincount(own, g[rows], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(own, h[rows], len(c) + 1))[:-1]
                nl = np.cumsum(np.bincount(own, minlength=len(c) + 1))[:-1]
                gain = gl**2 / (hl + ridge) + (sum_g - gl) ** 2 / (sum_h - hl + ridge) - sum_g**2 / (sum_h + ridge)
                gain[(nl < least) | (len(rows) - nl < least)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, k)
            _, f, k = best
            if f < 0:
                continue
            low = code[rows, f] <= k
            tree.feature[node], tree.limit[node] = f, float(cuts[f][k])
            tree.left[node], tree.right[node] = tree.add(0.0), tree.add(0.0)
            work += [(tree.left[node], rows[low], level + 1), (tree.right[node], rows[~low], level + 1)]
        model.trees.append(tree)
        odds += rate * tree.predict(x)
    return model
