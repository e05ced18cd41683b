"""Gradient-boosted trees on a bounded sample, with plain numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, RATE, BINS, LEAST_HESSIAN, RIDGE = 60, 3, 0.2, 32, 2.0, 1.0

# a tree is a list of nodes: (feature, edge, left, right) or (value,)
Tree = list[tuple]


@dataclass(frozen=True)
class Boosted:
    start: float
    trees: tuple[Tree, ...]

    def margin(self, row) -> float:
        """Log odds of one row of features."""
        total = self.start
        for tree in self.trees:
            node = tree[0]
            while len(node) > 1:
                node = tree[node[2] if row[node[0]] <= node[1] else node[3]]
            total += node[0]
        return total


def grow(codes: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray, depth: int) -> Tree:
    """One regression tree by the usual second-order gain, with shrunken leaves."""
    nodes: Tree = []

    def score(g, h):
        return g * g / (h + RIDGE)

    def add(rows: np.ndarray, left: int) -> int:
        place = len(nodes)
        nodes.append(())
        g, h = gradient[rows].sum(), hessian[rows].sum()
        best = (1e-6, -1, -1)
        if left and len(rows) > 1:
            for f, cuts in enumerate(edges):
                if not len(cuts):
                    continue
                code = codes[rows, f]
                gs = np.cumsum(np.bincount(code, gradient[rows], len(cuts) + 1))[:-1]
                hs = np.cumsum(np.bincount(code, hessian[rows], len(cuts) + 1))[:-1]
                gain = score(gs, hs) + score(g - gs, h - hs) - score(g, h)
                gain[(hs < LEAST_HESSIAN) | (h - hs < LEAST_HESSIAN)] = -1
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (float(gain[at]), f, at)
        if best[1] < 0:
            nodes[place] = (float(-RATE * g / (h + RIDGE)),)
            return place
        _, f, at = best
        under = codes[rows, f] <= at
        nodes[place] = (f, float(edges[f][at]), add(rows[under], left - 1), add(rows[~under], left - 1))
        return place

    add(np.arange(len(codes)), depth)
    return nodes


def fit_boosted(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Boosted:
    """Logistic loss; one class only, or no rows, gives the constant that fits."""
    y = np.asarray(y, float)
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Boosted(start, ())
    x = np.asarray(x, float)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    edges = [cuts[cuts < x[:, f].max()] for f, cuts in enumerate(edges)]
    codes = np.column_stack([np.searchsorted(cuts, x[:, f], side="left") for f, cuts in enumerate(edges)])
    margins, made = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margins))
        tree = grow(codes, edges, p - y, np.maximum(p * (1 - p), 1e-9), depth)
        if len(tree) == 1:
            break
        made.append(tree)
        one = Boosted(0.0, (tree,))
        margins += np.array([one.margin(row) for row in x])
    return Boosted(start, tuple(made))
