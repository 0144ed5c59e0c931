"""Gradient-boosted trees over small whole-number features, scored as a SQL expression.

Fitted on the driver from counts of distinct feature vectors (a bounded table);
the model becomes nested ``if`` expressions, so scoring needs no Python.
"""

from __future__ import annotations

import math


def _leaf(g: float, h: float, rate: float) -> float:
    return round(-rate * g / (h + 1.0), 6)


def _gain(g: float, h: float) -> float:
    return g * g / (h + 1.0)


def _grow(rows: list[tuple[tuple[int, ...], float, float]], depth: int, rate: float):
    """A tree: a number, or (feature, threshold, left for <=, right)."""
    total_g, total_h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = (1e-6, None, None)
    for f in range(len(rows[0][0])) if depth else ():
        by: dict[int, list[float]] = {}
        for x, g, h in rows:
            cell = by.setdefault(x[f], [0.0, 0.0])
            cell[0] += g
            cell[1] += h
        g = h = 0.0
        for value in sorted(by)[:-1]:
            g += by[value][0]
            h += by[value][1]
            gain = _gain(g, h) + _gain(total_g - g, total_h - h) - _gain(total_g, total_h)
            if gain > best[0]:
                best = (gain, f, value)
    if best[1] is None:
        return _leaf(total_g, total_h, rate)
    _, f, value = best
    return (f, value, _grow([r for r in rows if r[0][f] <= value], depth - 1, rate),
            _grow([r for r in rows if r[0][f] > value], depth - 1, rate))


def _value(tree, x) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


class Boosted:
    """Logistic boosting: ``score`` is a probability."""

    def __init__(self, rounds: int = 24, depth: int = 3, rate: float = 0.4):
        self.rounds, self.depth, self.rate, self.trees, self.start = rounds, depth, rate, [], 0.0

    def fit(self, counts: list[tuple[tuple[int, ...], int, int]]) -> Boosted:
        """``counts``: (features, positives, negatives)."""
        pos, neg = sum(c[1] for c in counts), sum(c[2] for c in counts)
        self.start = round(math.log((pos + 0.5) / (neg + 0.5)), 6)
        raw = [self.start] * len(counts)
        for _ in range(self.rounds if pos and neg else 0):
            rows = []
            for (x, p, n), z in zip(counts, raw):
                q = 1 / (1 + math.exp(-z))
                rows.append((x, (p + n) * q - p, (p + n) * q * (1 - q)))
            tree = _grow(rows, self.depth, self.rate)
            self.trees.append(tree)
            raw = [z + _value(tree, c[0]) for c, z in zip(counts, raw)]
        return self

    def score(self, x) -> float:
        z = self.start + sum(_value(t, x) for t in self.trees)
        return 1 / (1 + math.exp(-z))

    def sql(self, names: list[str]) -> str:
        """The score as SQL over the features called ``names``."""
        def branch(t) -> str:
            if not isinstance(t, tuple):
                return f"{t!r}D"
            return f"if({names[t[0]]} <= {t[1]}, {branch(t[2])}, {branch(t[3])})"
        return f"1D / (1D + exp(-({' + '.join([f'{self.start!r}D', *map(branch, self.trees)])})))"
