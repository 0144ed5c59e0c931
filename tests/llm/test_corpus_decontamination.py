"""Decontamination against a brute-force search."""

import random
import re

import pytest

from corpus_cases import as_set, documents, sentence
from stratus.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            iw = words(item)
            k = min(len(iw), 13)
            for i in range(len(iw) - k + 1) if k else ():
                for p in range(len(w) - k + 1):
                    if w[p:p + k] == iw[i:i + k]:
                        hit.update(range(p, p + k))
                        if item_id is not None:
                            found.add(str(item_id))
        out.append((doc_id, len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


def cases():
    rng = random.Random(4)
    items = [(i, sentence(rng, 20)) for i in range(6)] + [(10, "Éa short ITEM-two"), (11, "lone"), (12, ""), (13, None),
                                                         (None, sentence(rng, 15)), (14, sentence(rng, 13)), (15, "lone")]
    docs = [(i, sentence(rng, 60), "en", "s") for i in range(6)]
    docs += [(20, sentence(rng, 30) + ". " + items[0][1].upper() + "! " + sentence(rng, 10), "en", "s"),
             (21, "x " * 300 + items[1][1][:60], "en", "s"), (22, "Éa, short... item two", "en", None),
             (22, "Éa, short... item two", "en", None), (22, "other lone words", "en", "s"), (None, items[-2][1], "en", "s"),
             (24, None, None, None), (25, "", "en", "s"), (26, " \n\t", "en", "s"),
             (27, sentence(rng, 8000) + " lone " + items[2][1] * 3, "en", "s"), (28, items[10][1], "en", "s")]
    return docs, items


def result(df):
    rows = [(r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.fixture(scope="module")
def data(spark):
    docs, items = cases()
    return docs, items, documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")


def test_matches_brute_force(data):
    docs, items, df, bench = data
    assert result(D.find(df, bench)) == brute(docs, items)


def test_shuffle_join_gives_the_same(data, monkeypatch):
    docs, items, df, bench = data
    monkeypatch.setattr(D, "MAX_BROADCAST_WINDOWS", 0)
    assert result(D.find(df, bench)) == brute(docs, items)


def test_empty_tables(spark, data):
    docs, items, df, bench = data
    assert D.find(df.limit(0), bench).count() == 0
    none = D.find(df, bench.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.n_hit or r.contaminated for r in none)


def test_remove(data):
    docs, items, df, bench = data
    bad = [(r[0], r[4]) for r in brute(docs, items)]
    kept = D.remove_documents(df, bench)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, c in bad if not c)
    cut = {r.doc_id: r.text for r in D.remove_spans(df, bench).collect() if r.doc_id in (20, 25, 24, 0)}
    before = next(t for i, t, *_ in docs if i == 20)
    assert cut[24] is None and cut[25] == ""
    assert words(cut[20]) == words(before)[:30] + words(before)[50:] and before.startswith(cut[20][:60])
    assert as_set(D.remove_spans(df, bench), "lang") == as_set(df, "lang")
