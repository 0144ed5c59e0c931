"""Periodic runs against a direct search for every period."""

import hashlib
import random
import zlib

import pytest

from corpus_cases import documents, sentence
from stratus.llm import periodic_runs, queries


def brute(w, least=24, periods=3):
    n, out = len(w), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, periods * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((a, n, q) for (a, n), q in out.items())


def text(rng, size):
    w = []
    while len(w) < size:
        kind = rng.random()
        if kind < 0.3:
            w += [rng.randrange(rng.choice([2, 3, 50]))] * rng.randrange(1, 40)
        else:
            unit = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(1, rng.choice([4, 12, 30])))]
            unit = unit * rng.choice([1, 1, 2]) + [rng.randrange(3)] * rng.randrange(2)
            w += (unit * 6)[:rng.randrange(1, 5 * len(unit) + 1)]
    return [f"v{x}" for x in w]


@pytest.mark.parametrize("least", [1, 6, 24])
def test_all_runs_of_many_documents_at_once(least):
    rng = random.Random(least)
    for _ in range(250):
        texts = [text(rng, rng.randrange(1, 150)) for _ in range(rng.randrange(1, 5))] + [[]]
        got = periodic_runs._rows([[x.encode() for x in t] for t in texts], least, 3)
        for t, runs, collapsed in zip(texts, got["runs"], got["collapsed"]):
            found = [(r["start"], r["length"], r["period"]) for r in runs]
            assert found == brute(t, least)
            gone = {i for s, n, q in found for i in range(s + q, s + n)}
            assert collapsed == " ".join(x for i, x in enumerate(t) if i not in gone)


def test_names_too_large_for_one_number():
    import numpy as np
    name, pos = np.array([5, 1 << 61, 5, 0]), np.array([3, 2, 1, 0])
    got = periodic_runs._by_name(name, pos, 4)
    assert [x.tolist() for x in got] == [[0, 5, 5, 1 << 61], [0, 1, 3, 2]]


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        periodic_runs._rows([[b"a"] * 30], 1, 2)


def expected(doc_id, body):
    w = (body or "").encode().split()
    w = [x.decode() for x in w]
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (
        "".join(f"{s},{m},{q}\n" for s, m, q in runs), " ".join(x for i, x in enumerate(w) if i not in gone))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha)


def test_query_columns(spark):
    rng = random.Random(5)
    rows = [(i, " \t\n".join(text(rng, rng.randrange(1, 200))) + rng.choice(["", " ", "\r", " x"]), "en", "s")
            for i in rng.sample(range(10 ** 12), 120)]
    planted = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += [(i, sentence(rng, rng.randrange(1, 300)), "en", "s") for i in planted]
    rows += [(-3, None, None, None), (-4, "", "en", "s"), (planted[0], "", "en", "s"), (planted[1], None, "en", "s"), (None, "a " * 30, "en", "s"),
             (-5, "a " * 30, "en", "s"), (-5, "a " * 30, "en", "s"), (-6, "x\x1cy " * 30, "en", "s"), (-7, "é日 b " * 20000, "en", "s"),
             (planted[2], "one", "en", "s")]
    got = queries.runs_of(documents(spark, rows)).collect()
    want = [expected(d, t) for d, t, *_ in rows[:-4]] + [expected(rows[-4][0], rows[-4][1]), expected(rows[-3][0], rows[-3][1])]
    want += [None, expected(rows[-1][0], rows[-1][1])]
    by = sorted((str(tuple(r)) for r in got if r.doc_id != -7))
    assert by == sorted(str(w) for w in want if w is not None)
    long = [r for r in got if r.doc_id == -7]
    assert [(r.n_runs, r.start, r.length, r.period, r.exponent_milli) for r in long] == [(1, 0, 40000, 2, 20000000)]
    assert sum(r.n_runs for r in got) > 100


def test_empty_table(spark):
    assert queries.runs_of(documents(spark, [(1, "a", "en", "s")]).limit(0)).count() == 0
