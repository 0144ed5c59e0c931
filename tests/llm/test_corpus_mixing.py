"""Mixing: targets by hand, words taken near them, reruns alike."""

import random

import pytest

from corpus_cases import as_set, documents, sentence
from stratus.llm import mixing


def test_targets_are_reshared_until_none_is_above():
    got = mixing.targets([("b", 100), ("a", 10), (None, 1000), ("c", 50)])
    # order a, b, c, null with weights 3, 1, 2, 3; 150 % of 1160 is 1740
    assert [s for s, _, _ in got] == ["a", "b", "c", None]
    assert [t for _, _, t in got][:3] == [20.0, 200.0, 100.0]
    assert got[3][2] == pytest.approx(1740 - 320) and got[3][2] <= 2000
    assert mixing.targets([]) == [] and mixing.targets([("x", 0)]) == [("x", 0, 0.0)]
    for _, n, t in mixing.targets([(str(i), 100 + 7 * i) for i in range(20)]):
        assert 0 < t <= 2 * n


def corpus():
    rng = random.Random(2)
    rows = [(i, sentence(rng, rng.randrange(1, 300)), "en", rng.choice("aaaabcd")) for i in range(1500)]
    rows += [(5000, None, None, "a"), (5001, "", "en", "a"), (5002, "x", "en", None), (5003, "y z", "en", None),
             (None, "no id here", "en", "b"), (5004, "same", "en", "c"), (5004, "same", "en", "c"), (5004, "other", "en", "c"),
             (5005, sentence(rng, 20000), "en", "d"), (5006, None, "en", "zero")]
    return rows


def test_words_taken(spark):
    rows = corpus()
    df = documents(spark, rows)
    got = mixing.mix(df, leaf_rows=40).collect()
    assert len(got) == len(rows)
    want = {}
    for _, text, _, source in rows:
        want[source] = want.get(source, 0) + len((text or "").split())
    assert sorted({(r.source_size, r.target) for r in got}) == sorted({(n, t) for _, n, t in mixing.targets(list(want.items()))})
    by = {}
    for r in got:
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
        cell = by.setdefault((r.source_size, r.target), [0, 0])
        cell[0] += r.taken
        cell[1] = max(cell[1], r["size"])
    for (_, target), (taken, _) in by.items():
        assert abs(taken - target) <= max(30, 0.02 * target)
    assert sorted(str(r.id_text) for r in got) == sorted(str(r[0]) for r in rows)


def test_reruns_and_partitions_agree(spark):
    df = documents(spark, corpus())
    one = as_set(mixing.mix(df, leaf_rows=40), "id_text", "size", "copies")
    assert one == as_set(mixing.mix(df.repartition(7), leaf_rows=40), "id_text", "size", "copies")
    assert one != as_set(mixing.mix(df, leaf_rows=40, seed=8), "id_text", "size", "copies")


def test_chances_are_kept():
    """Over many seeds each unit is taken as often as its probability says."""
    import pandas as pd
    sizes = [5, 50, 500, 20, 7, 90]
    taken = [0] * len(sizes)
    for seed in range(3000):
        pdf = pd.DataFrame({"sid": 0, "leaf": 0, "leaves": 2, "unit_key": [f"k{i}" for i in range(6)], "size": sizes, "p": 0.3, "copies": 0})
        for out in mixing._rounder(seed)(iter([pdf])):
            for r in out.itertuples():
                taken[int(r.unit_key[1:])] += r.copies + r.p
    assert all(abs(t / 3000 - 0.3) < 0.04 for t in taken)


def test_apply_repeats_rows(spark):
    df = documents(spark, corpus())
    mixed = mixing.apply_mix(df, leaf_rows=40)
    assert mixed.columns == df.columns
    words = mixed.selectExpr("sum(size(regexp_extract_all(coalesce(text, ''), '[^ ]+', 0))) as n").first().n
    total = sum(len((t or "").split()) for _, t, _, _ in corpus())
    assert abs(words - 1.5 * total) < 0.02 * total
    assert mixed.groupBy("doc_id", "text").count().where("count > 4").count() == 0


def test_empty_table(spark):
    df = documents(spark, corpus()).limit(0)
    assert mixing.mix(df).count() == 0 and mixing.apply_mix(df).columns == df.columns
