"""Operators against brute-force Python on random small inputs."""

import datetime as dt
import math
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratus.operators import analytics, daily_features, quality

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
BASE = dt.date(2018, 12, 20)

days = st.lists(st.integers(min_value=0, max_value=800), min_size=0, max_size=40)


def _gaps(ds):
    present = sorted(set(ds))
    out = []
    for a, b in zip(present, present[1:]):
        if (b - a).days > 1:
            out.append((a + dt.timedelta(days=1), b - dt.timedelta(days=1), (b - a).days - 1))
    return out


@SETTINGS
@given(days)
def test_temporal_gaps_brute_force(spark, offsets):
    ds = [BASE + dt.timedelta(days=o) for o in offsets]
    df = spark.createDataFrame([(d,) for d in ds] + [(None,)], "d date")
    got = sorted(tuple(r) for r in quality.temporal_gaps(df, "d").collect())
    assert got == _gaps(ds)


values = st.lists(st.one_of(st.none(), st.integers(min_value=-40, max_value=40).map(float)),
                  min_size=1, max_size=70)


def _features(rows):
    """Month-scoped rolling/lag features by brute force over the sorted rows."""
    out = {}
    by_month = {}
    for d, v in sorted(rows):
        by_month.setdefault((d.year, d.month), []).append((d, v))
    for seq in by_month.values():
        for i, (d, v) in enumerate(seq):
            w7 = [x for _, x in seq[max(0, i - 6):i + 1] if x is not None]
            w30 = [x for _, x in seq[max(0, i - 29):i + 1] if x is not None]
            prev1 = seq[i - 1][1] if i >= 1 else None
            prev7 = seq[i - 7][1] if i >= 7 else None
            out[d] = {
                "temp_7d_avg": sum(w7) / len(w7) if w7 else None,
                "temp_30d_avg": sum(w30) / len(w30) if w30 else None,
                "temp_7d_std": statistics.stdev(w7) if len(w7) > 1 else None,
                "temp_7d_min": min(w7) if w7 else None,
                "temp_7d_max": max(w7) if w7 else None,
                "temp_change_1d": v - prev1 if v is not None and prev1 is not None else None,
                "temp_change_7d": v - prev7 if v is not None and prev7 is not None else None,
            }
    return out


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@SETTINGS
@given(values, st.integers(min_value=0, max_value=3))
def test_month_features_brute_force(spark, vals, step):
    # Days step 1..4 apart, so months hold varying row counts and some holes.
    rows, d = [], dt.date(2020, 1, 20)
    for v in vals:
        rows.append((d, v))
        d += dt.timedelta(days=1 + step)
    got = {r["date"]: r for r in daily_features(
        spark.createDataFrame(rows, "date date, avg_tempC double")).collect()}
    want = _features(rows)
    assert got.keys() == want.keys()
    for day, cols in want.items():
        for name, value in cols.items():
            assert _close(got[day][name], value), (day, name, got[day][name], value)


@SETTINGS
@given(values)
def test_anomaly_zscore_brute_force(spark, vals):
    rows = [(dt.date(2021, 3, 1) + dt.timedelta(days=i), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "date date, avg_tempC double")
    got = {r.date: r.zscore for r in analytics.anomaly_zscore(df, threshold=1.0).collect()}
    want = {}
    by_month = {}
    for d, v in rows:
        by_month.setdefault((d.year, d.month), []).append((d, v))
    for seq in by_month.values():
        for i, (d, v) in enumerate(seq):
            prev = [x for _, x in seq[max(0, i - 7):i] if x is not None]
            if v is None or len(prev) < 2:
                continue
            sd = statistics.stdev(prev)
            if sd > 0 and abs((v - sum(prev) / len(prev)) / sd) > 1.0:
                want[d] = (v - sum(prev) / len(prev)) / sd
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


TS = dt.datetime(2020, 1, 1)
# (temperature, pressure, date present) per distinct row; multiplicity drawn separately.
KINDS = [(10.0, 1000.0, True), (None, 1000.0, True), (10.0, 0.0, True), (10.0, None, True),
         (10.0, 1000.0, False), (float("nan"), 790.0, True)]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, len(KINDS) - 1), st.integers(1, 9)), max_size=8))
def test_quarantine_brute_force(spark, groups):
    from collections import Counter

    from tests.fixtures import READING_SCHEMA, reading
    rows, want = [], Counter()
    for i, (k, m) in enumerate(groups):
        temp, pressure, dated = KINDS[k]
        r = reading(i, TS if dated else None, temp=temp, pressure=pressure)
        rows += [r] * m
        rule = ("null_critical" if not dated or temp is None
                else "invalid_pressure" if pressure is None or not (pressure > 0 and pressure >= 800)
                else None)
        want[(i, rule or "duplicate")] += 0
        if rule:
            want[(i, rule)] += 1
        want[(i, "duplicate")] += m - 1
    want = +want
    df = spark.createDataFrame(rows, READING_SCHEMA)
    got = Counter({(r.reading_id, r.reason): r.copies for r in quality.quarantine_rows(df).collect()})
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 60),
                          st.one_of(st.none(), st.integers(-20, 20).map(float))),
                max_size=40, unique_by=lambda t: (t[0], t[1])))
def test_series_scope_features_brute_force(spark, points):
    start = dt.date(2020, 2, 20)
    rows = [(s, start + dt.timedelta(days=o), v) for s, o, v in points]
    df = spark.createDataFrame(rows, "station string, date date, avg_tempC double")
    got = {(r.station, r.date): r for r in daily_features(
        df, scope="series", series_keys=("station",)).collect()}
    by_key = {(s, d): v for s, d, v in rows}
    for (s, d), v in by_key.items():
        w7 = [by_key[(s, d - dt.timedelta(days=k))] for k in range(7)
              if (s, d - dt.timedelta(days=k)) in by_key]
        w7 = [x for x in w7 if x is not None]
        prev1 = by_key.get((s, d - dt.timedelta(days=1)))
        prev7 = by_key.get((s, d - dt.timedelta(days=7)))
        r = got[(s, d)]
        assert _close(r.temp_7d_avg, sum(w7) / len(w7) if w7 else None)
        assert _close(r.temp_7d_max, max(w7) if w7 else None)
        assert _close(r.temp_change_1d, v - prev1 if v is not None and prev1 is not None else None)
        assert _close(r.temp_change_7d, v - prev7 if v is not None and prev7 is not None else None)
    assert len(got) == len(by_key)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(*[st.none() | st.sampled_from([0.0, -0.0, 1.0, 2.5, 7.0]) | st.integers(-50, 50).map(float)] * 3), min_size=2, max_size=80))
def test_rank_correlation(spark, rows):
    """Average ranks by counting, then Pearson, per pair over the rows that have both."""
    from stratus.operators.analytics import rank_correlation
    df = spark.createDataFrame(rows, "temperatureC double, humidity double, visibility_km double")
    got = {(r.metric_a, r.metric_b): (r.n, r.corr) for r in rank_correlation(df).collect()}
    names = ["temperatureC", "humidity", "visibility_km"]
    for i in range(3):
        for j in range(i + 1, 3):
            both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
            if not both:
                assert (names[i], names[j]) not in got
                continue
            x, y = ([sum(w < v for w in c) + (sum(w == v for w in c) + 1) / 2 for v in c] for c in zip(*both))
            m = (len(both) + 1) / 2
            ab, aa, bb = (sum((p - m) * (q - m) for p, q in zip(u, v)) for u, v in ((x, y), (x, x), (y, y)))
            n, corr = got[names[i], names[j]]
            assert n == len(both)
            assert corr is None if aa * bb == 0 else abs(corr - ab / (aa * bb) ** 0.5) < 1e-9
