"""Embedding links against all pairs."""

import numpy as np
import pytest

from corpus_cases import CLASHES, as_set, components
from pyspark.sql import functions as F
from stratus.llm import pstable


def brute(rows):
    ok = [i for i, (v, e, lab) in enumerate(rows) if v is not None and lab is not None and e
          and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    links, edges = {i: 0 for i in range(len(rows))}, []
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], dtype=float), np.array(rows[b][1], dtype=float)
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.98:
                    links[a] += 1
                    links[b] += 1
                    edges.append((a, b))
    root = components(list(range(len(rows))), edges)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root[i]] = min(least.get(root[i], r[0]), r[0])
    out = [(r[0], links[i], None if r[0] is None else least[root[i]]) for i, r in enumerate(rows)]
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


def cases():
    rng = np.random.default_rng(6)
    rows, at = [], 10
    for size, noise in ((60, 0.012), (30, 0.018), (20, 0.022), (8, 0.0)):
        centre = rng.standard_normal(64)
        centre /= np.sqrt(centre @ centre)
        for _ in range(size):
            rows.append((at, (centre + noise * rng.standard_normal(64)).tolist(), at % 2 if size == 60 else 3))
            at += 1
    rows += [(at + i, rng.standard_normal(64).tolist(), 3) for i in range(60)]
    one = rows[0][1]
    rows += [(1, None, 0), (2, [], 0), (3, [0.0] * 64, 0), (4, [float("nan"), *one[1:]], 0), (5, [float("inf"), *one[1:]], 0),
             (6, [None, *one[1:]], 0), (7, one, None), (None, one, 0), (8, [2 * x for x in one], 0), (9, one[:32], 0),
             (9000, one, 0), (9000, one, 0), (9000, rows[100][1], 3), (9001, [-0.0, 1.0], 0), (9002, [0.0, 1.0], 0),
             (9003, [1e-30 * x for x in one], 0)]
    return rows


@pytest.mark.parametrize("kind, block", [("double", 512), ("double", 7), ("float", 16)])
def test_matches_brute_force(spark, kind, block):
    rows = cases()
    if kind == "float":
        rows = [(v, e and [x if x is None else float(np.float32(x)) for x in e], lab) for v, e, lab in rows]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    df = df.withColumns({c: F.lit("clash") for c in CLASHES if c != "label"})
    got = pstable.link(df.repartition(3), block=block)
    assert as_set(got, "vec_id", "n_links", "component_id") == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert pstable.link(df).count() == 0


def test_vectors_of_any_size(spark):
    """Near-equal directions link however long the vectors are; scaling changes no cosine."""
    rng = np.random.default_rng(4)
    centre, rows = rng.standard_normal(16), []
    for i, size in enumerate([1e-200, 1e200, 1.0, 1e-300, 1e300, 1e-160]):
        rows.append((i, ((centre + 0.01 * rng.standard_normal(16)) * size).tolist(), 1))
    rows += [(10, [1e-310] + [0.0] * 15, 1), (11, [5e-310] + [0.0] * 15, 1), (12, (-centre * 1e200).tolist(), 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in pstable.link(spark.createDataFrame(
        rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert [got[i] for i in range(6)] == [(5, 0)] * 6
    assert got[10] == got[11] == (1, 10) and got[12] == (0, 12)
    m = rng.standard_normal((50, 16)) * 10.0 ** rng.integers(-9, 9, (50, 1))

    def cosines(v):
        norm = np.sqrt((v * v).sum(axis=1))
        return (v[1:] * v[:-1]).sum(axis=1) / (norm[1:] * norm[:-1])
    assert np.array_equal(cosines(m), cosines(pstable._scaled(m)))
