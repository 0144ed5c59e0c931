"""Substring dedup against a brute-force pass in rank order."""

import random

import pytest

from corpus_cases import as_set, documents, sentence
from stratus.llm import line_dedup as D


def brute(rows, kind, min_words):
    """Removed ranges per document, in rank order of (id, hash order is not needed: no repeated ids here)."""
    seen, out = set(), {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        run, removed = [], []

        def close():
            if sum(len(n.split()) for _, _, n in run) >= min_words:
                removed.append((run[0][0], run[-1][1]))
            run.clear()
        for u in D.units(text or "", kind):
            if u[2] in seen:
                run.append(u)
            else:
                close()
                seen.add(u[2])
        close()
        out[doc_id] = removed
    return out


def prose(rng, n):
    return " ".join(sentence(rng, rng.randrange(4, 14)).capitalize() + rng.choice(".!?") for _ in range(n))


def cases():
    rng = random.Random(9)
    passage = prose(rng, 9)
    line = sentence(rng, 25) + "."
    rows = [(i, prose(rng, 12), "en", "s") for i in range(20)]
    rows += [(100 + i, prose(rng, 3) + " " + passage + " " + prose(rng, 3), "en", "s") for i in range(15)]
    rows += [(200 + i, prose(rng, 2) + "\n" + line.upper() + "\n" + prose(rng, 2), "en", "s") for i in range(6)]
    rows += [(300 + i, prose(rng, 2) + " See you soon. " + prose(rng, 2), "en", "s") for i in range(6)]
    rows += [(400, rows[0][1], "en", "s"), (401, None, None, None), (402, "", "en", "s"), (403, ".!? \n\n", "en", "s"),
             (None, passage, "en", "s"), (404, (line + "\n") * 5, "en", "s"), (405, "é " * 20000, "fr", "s"),
             (406, prose(rng, 4000), "en", "s")]
    return rows


@pytest.mark.parametrize("kind", ["sentence", "line", "paragraph"])
def test_matches_brute_force(spark, kind):
    rows = cases()
    got = D.find(documents(spark, rows).repartition(3), kind=kind).collect()
    assert len(got) == len(rows)
    want = brute(rows, kind, D.MIN_WORDS)
    for r in got:
        assert [tuple(x) for x in r.removed] == want[r.doc_id], r.doc_id
        assert r.n_units == len(D.units(next(t for i, t, *_ in rows if i == r.doc_id) or "", kind))


def test_passages_go_and_clean_texts_stay(spark):
    rows = cases()
    got = {r.doc_id: r for r in D.find(documents(spark, rows)).collect()}
    assert all(got[100 + i].n_removed >= 8 for i in range(15)) and got[None].n_removed == 0
    assert all(got[i].n_removed == 0 for i in range(20)) and all(got[300 + i].n_removed == 0 for i in range(6))
    assert got[400].words_removed == len(" ".join(u[2] for u in D.units(rows[0][1])).split())
    assert got[200].n_removed == 0 and all(got[200 + i].n_removed == 1 for i in range(1, 6))


def test_remove(spark):
    rows = cases()
    df = documents(spark, rows)
    out = D.remove(df)
    assert out.columns == df.columns and as_set(out, "doc_id") == as_set(df, "doc_id")
    texts, want = {r.doc_id: r.text for r in out.collect()}, brute(rows, "sentence", D.MIN_WORDS)
    for doc_id, text, *_ in rows:
        for a, b in reversed(want[doc_id]):
            text = text[:a] + text[b:]
        assert texts[doc_id] == text


def test_repeated_rows_and_empty_table(spark):
    rng = random.Random(1)
    text = prose(rng, 8)
    df = documents(spark, [(1, text, "en", "s"), (1, text, "en", "s"), (2, text, "en", "s")])
    got = {r.doc_id: r.n_removed for r in D.find(df).collect()}
    assert got == {1: 0, 2: len(D.units(text))}
    assert D.find(df.limit(0)).count() == 0 and D.remove(df.limit(0)).count() == 0


def test_short_lines_and_paragraphs_go_short_sentences_stay(spark):
    rng = random.Random(3)
    line, two = "Click here to read more", "Sign up now. It is free!"
    rows = [(i, f"{prose(rng, 3)}\n{line.upper() if i % 2 else line}.\n{prose(rng, 1)} {line}. {prose(rng, 2)}\r\n{two}\n", "en", "s")
            for i in range(6)]
    rows += [(10, f"{prose(rng, 2)}\n\nOne two three\nfour five six.\n\n{prose(rng, 2)}", "en", "s"),
             (11, f"{prose(rng, 2)}\n\none two\nthree four, five six\n \n{prose(rng, 2)}", "en", "s")]
    got = {r.doc_id: [rows[min(r.doc_id, 10) if r.doc_id < 10 else r.doc_id - 4][1][a:b].strip() for a, b in r.removed]
           for r in D.find(documents(spark, rows)).collect()}
    assert got[0] == [] and got[10] == [] and got[11] == ["one two\nthree four, five six"]
    assert all([x.lower() for x in got[i]] == [line.lower() + ".", two.lower()] for i in range(1, 6))


def test_passages_inside_sentences_go(spark):
    rng = random.Random(5)
    passage = sentence(rng, 70, 5000)
    rows = [(i, f"{sentence(rng, 30, 5000)} {passage.upper() if i % 2 else passage} {sentence(rng, 40, 5000)}", "en", "s") for i in range(8)]
    rows += [(20 + i, sentence(rng, 120, 5000), "en", "s") for i in range(8)]
    rows += [(30, prose(rng, 3) + " " + passage.replace(" ", ". ", 1) + "! " + prose(rng, 3), "en", "s"), (40, passage, "en", "s")]
    texts = {r[0]: r[1] for r in rows}
    got = {r.doc_id: r for r in D.find(documents(spark, rows)).collect()}
    for i, r in got.items():
        cut = " ".join(texts[i][a:b] for a, b in r.removed).lower()
        if i == 0 or 20 <= i < 30:
            assert r.removed == [] and r.words_removed == 0
        else:
            assert set(passage.split()) <= set(D._NOT_WORD.sub(" ", cut).split()), i
            assert 70 <= r.words_removed <= 72 and len(r.removed) == 1
    out = {r.doc_id: r.text for r in D.remove(documents(spark, rows)).collect()}
    assert out[0] == texts[0] and all(passage not in out[i].lower() for i in range(1, 8)) and out[40] == ""
