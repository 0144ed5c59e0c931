"""Penalised segmentation against planted shifts and an unpruned solver."""

import datetime as dt
import math
import random
import statistics

from stratus.operators.analytics import change_points

START = dt.date(2001, 1, 1)


def _frame(spark, series):
    rows = [(k, START + dt.timedelta(i), v) for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "k string, date date, v double")


def _ends(df, penalty=3.0):
    out = {}
    for r in sorted(change_points(df, "v", penalty=penalty, series_keys=("k",)).collect(), key=lambda r: (r.k, r.segment)):
        ends = out.setdefault(r.k, [])
        assert r.segment == len(ends) + 1
        ends.append((ends[-1] if ends else 0) + r.n_days)
    return out


def _unpruned(vs, penalty=3.0):
    n, mu = len(vs), sum(vs) / len(vs)
    steps = [abs(b - a) for a, b in zip(vs, vs[1:])]
    noise = statistics.median(steps) / 0.9539 if steps else 0.0
    beta = max(penalty * noise ** 2 * math.log(n), 1e-6)
    cost, cut = [0.0], [0]
    for t in range(1, n + 1):
        def upto(a):
            part = [v - mu for v in vs[a:t]]
            m = sum(part) / len(part)
            return cost[a] + sum((x - m) ** 2 for x in part) + beta
        best = min(range(t), key=upto)
        cost.append(upto(best))
        cut.append(best)
    ends, t = [], n
    while t:
        ends.append(t)
        t = cut[t]
    return ends[::-1]


def test_planted_shifts(spark):
    rng = random.Random(4)
    vs = [level + rng.gauss(0, 1) for level, n in ((0, 120), (6, 80), (-3, 200), (-3, 50)) for _ in range(n)]
    assert _ends(_frame(spark, {"a": vs})) == {"a": [120, 200, 450]}


def test_equals_the_unpruned_solution(spark):
    rng = random.Random(8)
    series = {}
    for k in range(12):
        level, vs = 0.0, []
        for _ in range(rng.randint(1, 70)):
            level += rng.choice([0] * 9 + [4, -5])
            vs.append(1e3 * k + level + rng.gauss(0, 1))
        series[f"s{k:02d}"] = vs
    for penalty in (1.0, 3.0):
        assert _ends(_frame(spark, series), penalty) == {k: _unpruned(vs, penalty) for k, vs in series.items()}


def test_edges(spark):
    df = _frame(spark, {"one": [2.0], "flat": [5.0] * 9, "step": [1.0] * 5 + [2.0] * 5, "gaps": [1.0, None, float("nan"), 1.0], "none": [None]})
    assert _ends(df) == {"one": [1], "flat": [9], "step": [5, 10], "gaps": [2]}
    assert change_points(df.where("false"), "v", series_keys=("k",)).count() == 0
    rows = {r.segment: r for r in change_points(df.where("k = 'step'"), "v").collect()}
    assert (rows[1].mean, rows[1].change, rows[2].change) == (1.0, None, 1.0)
    assert rows[2].start_date == START + dt.timedelta(5) and rows[2].end_date == START + dt.timedelta(9)
