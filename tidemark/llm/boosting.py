"""Gradient-boosted trees for a yes/no label, flattened into node arrays.

Trees are grown on histograms of binned features with the logistic loss. A constraint of +1 or -1
on a feature makes the score rise or fall with it: a split that breaks the order is not taken, and
the values below a split stay on their side of its middle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Node i of all trees: go to `left[i]` if row[feature[i]] <= threshold[i], else to `left[i] + 1`;
    a leaf points at itself through `leaf`. `roots` begin the trees."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    leaf: np.ndarray
    value: np.ndarray
    depth: int

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of the rows of a matrix; all rows go down a tree together."""
        total = np.full(len(rows), self.base)
        which = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                right = rows[which, self.feature[node]] > self.threshold[node]
                node = np.where(self.leaf[node], node, self.left[node] + right)
            total += self.value[node]
        return total

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(rows)))


def fit_trees(
    rows: np.ndarray,
    labels: np.ndarray,
    monotone: dict[int, int] | None = None,
    rounds: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    penalty: float = 1.0,
    least: float = 1.0,
) -> Trees:
    """`least` is the smallest sum of second derivatives in a leaf; without rows the odds are even."""
    n, width = rows.shape
    share = (labels.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for j in range(width)]
    binned = np.stack([np.searchsorted(c, rows[:, j], "left") for j, c in enumerate(cuts)]) if n else np.zeros((width, 0), int)
    order = np.zeros(width, int)
    for j, sign in (monotone or {}).items():
        order[j] = sign
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "leaf", "value")}
    roots: list[int] = []

    def new_node() -> int:
        for k, v in (("feature", 0), ("threshold", 0.0), ("left", 0), ("leaf", True), ("value", 0.0)):
            nodes[k].append(v)
        return len(nodes["feature"]) - 1

    margin = np.full(n, base)
    for _ in range(rounds if n else 0):
        chance = 1 / (1 + np.exp(-margin))
        slope, curve = chance - labels, np.maximum(chance * (1 - chance), 1e-9)
        roots.append(new_node())
        open_ = [(roots[-1], np.arange(n), -np.inf, np.inf)]
        for level in range(depth + 1):
            following = []
            for node, members, low, high in open_:
                g, h = slope[members], curve[members]
                own = float(np.clip(-g.sum() / (h.sum() + penalty), low, high))
                split = _best_split(binned[:, members], g, h, cuts, order, low, high, penalty, least) if level < depth else None
                if split is None:
                    nodes["value"][node] = own * rate
                    margin[members] += own * rate
                    continue
                feature, at, a, b = split
                left, right = new_node(), new_node()
                nodes["feature"][node], nodes["threshold"][node] = feature, float(cuts[feature][at])
                nodes["left"][node], nodes["leaf"][node] = left, False
                goes = binned[feature, members] <= at
                bounds = [(low, high), (low, high)]
                if order[feature]:
                    middle = (a + b) / 2
                    bounds = [(low, middle), (middle, high)]
                    if order[feature] < 0:
                        bounds = [(middle, high), (low, middle)]
                following += [(left, members[goes], *bounds[0]), (right, members[~goes], *bounds[1])]
            open_ = following
    kinds = {"feature": int, "threshold": float, "left": int, "leaf": bool, "value": float}
    arrays = {k: np.array(v, kinds[k]) for k, v in nodes.items()}
    return Trees(base=base, roots=np.array(roots, int), depth=depth, **arrays)


def _best_split(binned, g, h, cuts, order, low, high, penalty, least):
    """(feature, last bin of the left side, left value, right value) of the largest gain, or None."""
    best, gain_of_best = None, 1e-6
    whole_g, whole_h = g.sum(), h.sum()
    for j, cut in enumerate(cuts):
        if not len(cut):
            continue
        left_g = np.cumsum(np.bincount(binned[j], g, len(cut) + 1))[:-1]
        left_h = np.cumsum(np.bincount(binned[j], h, len(cut) + 1))[:-1]
        right_g, right_h = whole_g - left_g, whole_h - left_h
        a = np.clip(-left_g / (left_h + penalty), low, high)
        b = np.clip(-right_g / (right_h + penalty), low, high)
        own = np.clip(-whole_g / (whole_h + penalty), low, high)
        loss = lambda v, s, c: s * v + (c + penalty) * v * v / 2
        gain = loss(own, whole_g, whole_h) - loss(a, left_g, left_h) - loss(b, right_g, right_h)
        gain[(left_h < least) | (right_h < least) | (order[j] * (b - a) < 0)] = 0
        at = int(gain.argmax())
        if gain[at] > gain_of_best:
            gain_of_best, best = gain[at], (j, at, a[at], b[at])
    return best
