"""Near-duplicates against exact Jaccard over all pairs, and components of graphs."""

import random

import pytest

from corpus_cases import as_set, components, documents, sentence
from stratus.llm import lsh_forest
from stratus.llm.components import connected_components


def shingles(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute(rows, k):
    ids = list(range(len(rows)))
    sets = [shingles(r[1], k) for r in rows]
    edges = [(a, b) for a in ids for b in ids[:a] if sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = components(ids, edges)
    least = {}
    for i in ids:
        if rows[i][0] is not None:
            least[root[i]] = min(least.get(root[i], rows[i][0]), rows[i][0])
    return sorted(((r[0], len(sets[i]), None if r[0] is None else least[root[i]]) for i, r in enumerate(rows)),
                  key=lambda r: tuple((x is not None, str(x)) for x in r))


def edit(rng, text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(w)


def cases():
    rng = random.Random(12)
    rows, at = [], 100
    for size, n, edits in ((40, 160, 2), (25, 160, 3), (6, 40, 1), (5, 400, 6), (3, 12, 1)):
        first = sentence(rng, n)
        for _ in range(size):
            rows.append((at, edit(rng, first, rng.randrange(edits + 1)), "en", "s"))
            at += 1
    text = sentence(rng, 120)      # a chain: each links to the next, the ends do not
    for _ in range(12):
        text = edit(rng, text, 2)
        rows.append((at, text, "en", "s"))
        at += 1
    passage = sentence(rng, 50)    # shared by many that are otherwise apart
    rows += [(at + i, sentence(rng, 40) + " " + passage, "en", "s") for i in range(30)]
    rows += [(9000, sentence(rng, 30000), "en", "s"), (1, None, None, None), (2, "", "en", "s"), (3, " \t\r\n", "en", "s"),
             (4, "One two", "en", "s"), (5, "one TWO", "en", "s"), (6, "one two three", "en", "s"), (7, "É two", "en", "s"),
             (8, "é two", "en", "s"), (None, rows[0][1], "en", "s"), (10, rows[0][1], "en", "s"), (10, rows[0][1], "en", "s"),
             (11, "a\x1cb c d", "en", "s"), (12, "a b c d", "en", "s"), (13, sentence(rng, 4), "en", "s"), (4, text, "en", "s")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k", [4, 5])
def test_matches_brute_force(spark, k):
    rows = cases()
    got = lsh_forest.link(documents(spark, rows).repartition(4), shingle=k)
    assert as_set(got, "doc_id", "n_shingles", "component_id") == brute(rows, k)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.where("doc_id is not null").collect())


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = cases()
    monkeypatch.setattr(lsh_forest, "BLOCK", 4)
    got = lsh_forest.link(documents(spark, rows))
    assert as_set(got, "doc_id", "n_shingles", "component_id") == brute(rows, 5)


def test_keep_one(spark):
    rows = cases()
    df = documents(spark, rows)
    kept = lsh_forest.keep_one(df)
    assert kept.columns == df.columns
    want = {(str(r[0]), c) for r, c in ((r, r[2]) for r in brute(rows, 5)) if r[0] is None or r[0] == r[2]}
    assert {str(r.doc_id) for r in kept.collect()} == {i for i, _ in want}
    assert kept.where("doc_id is null or doc_id in (1, 2, 3)").count() == 4


def test_empty_table(spark):
    df = documents(spark, [(1, "x", "en", "s")]).limit(0)
    assert lsh_forest.link(df).count() == 0 and lsh_forest.keep_one(df).columns == df.columns


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(1000, 1300)] + [(1, j) for j in range(2, 200)] + [(500 + i, 500 + (i + 1) % 40) for i in range(40)]
    edges += [(7000, 7000)] + [(b, a) for a, b in edges[:50]]
    edges += [(rng.randrange(3000, 3300), rng.randrange(3000, 3300)) for _ in range(200)]
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    root = components(nodes, [e for e in edges if e[0] != e[1]])
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == sorted(root.items())
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("local_edges", [0, 100, None])
def test_components_by_rounds_and_in_one_task(spark, local_edges):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(300)] * 2 + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(150)]
    edges += [(None, 3), (9000, 9000)]
    real = [e for e in edges if None not in e and e[0] != e[1]]
    root = components(sorted({x for e in real for x in e}), real)
    got = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(5), local_edges=local_edges)
    assert sorted(map(tuple, got.collect())) == sorted(root.items())


def test_few_edges_take_no_rounds(spark, monkeypatch):
    from stratus.llm import components as module
    staged = []
    monkeypatch.setattr(module, "stage", lambda df, name, f=module.stage: staged.append(name) or f(df, name))
    edges = spark.createDataFrame([(i, i + 1) for i in range(2000)], "a long, b long")
    assert connected_components(edges).where("component = 0").count() == 2001
    assert len(staged) == 2
