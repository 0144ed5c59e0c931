"""Spelling variants against all pairs of words, and the counts behind them."""

import random
import re
import zlib
from collections import Counter

import pytest

from corpus_cases import as_set, documents
from stratus.llm import spelling


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=10):
    words = sorted(counts)
    partners = {w: [v for v in words if v != w and near(v, w)] for w in words}
    form = {}
    for w, others in partners.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    rows = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, counts[w], len(partners[w]), form[w], counts.get(form[w]), root))
    return rows


COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def vocabulary(rng, n, letters="abé", low=7, high=11):
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(low, high))) for _ in range(n)}
    return {w: rng.choice([2, 2, 3, 5, 20, 45, 200, 2500, 26000]) for w in words}


@pytest.mark.parametrize("levels, group_pairs", [(1, 50_000), (2, 50_000), (2, 3), (1, 0), (3, 0)])
def test_all_pairs(spark, levels, group_pairs):
    counts = vocabulary(random.Random(4), 260) | {"qwertyu": 2, "qwertyx": 30, "qwertxx": 400, "qwerxxx": 9000, "qwerxx": 90000}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.group_variants(df, levels=levels, group_pairs=group_pairs)
    want = brute(counts)
    assert as_set(got, *COLUMNS) == sorted(want, key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert any(r[3] for r in want) and any(r[5] not in (r[0], r[3]) for r in want)


def test_one_crowded_chunk(spark):
    """Words that all begin alike, the hot group of every level."""
    rng = random.Random(9)
    counts = {"commonprefix" + w: n for w, n in vocabulary(rng, 250, "ab", 4, 10).items()}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.near_pairs(df, group_pairs=20)
    words = sorted(counts)
    want = sorted((a, b) if len(a) <= len(b) else (b, a) for i, a in enumerate(words) for b in words[i + 1:] if near(a, b))
    assert sorted(map(tuple, got.select("a", "b").collect())) == want and len(want) > 300


def test_words_of_whole_texts(spark):
    rng = random.Random(3)
    words = ["Straßenbahn", "strassenbahn", "ÀÈÌÒÙàè", "kurz", "letters", "letterss", "LETTERS", "naïvetés", "x" * 3000]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", ".", "1", "-", "日"]) for _ in range(rng.randrange(60))), "en", "s")
            for i in range(120)]
    rows += [(900, None, None, None), (901, "", "en", "s"), (None, "letters letters", "en", "s"), (902, "letters " * 3000, "en", "s"),
             (902, "letters " * 3000, "en", "s"), (903, "singular1", "en", "s")]
    got = spelling.variants(documents(spark, rows), change=spelling.drop_letters)
    counts, run, small = Counter(), re.compile("[A-Za-zÀ-ÿ]+"), str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for doc_id, text, *_ in rows:
        for w in run.findall(text or ""):
            w = w.translate(small)
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                counts[w] += 1
    want = brute({w: n for w, n in counts.items() if n >= 2})
    assert as_set(got, *COLUMNS) == sorted(want, key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert any(r[3] for r in want)


def test_held_words_are_handed_on(spark, monkeypatch):
    import pandas as pd
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    text = "alphabet betatest gammaray deltawing epsilon alphabet"
    out = pd.concat(spelling._counter(7, None)(iter([pd.DataFrame({"id": ["1", "2"], "text": [text, text]})])))
    assert out.groupby("word")["n"].sum().to_dict() == {"alphabet": 4, "betatest": 2, "gammaray": 2, "deltawing": 2, "epsilon": 2}
    assert len(out) > 5


def test_empty_table_and_wrong_parameters(spark):
    df = documents(spark, [(1, "letters letters", "en", "s")])
    assert spelling.variants(df.limit(0)).count() == 0
    assert as_set(spelling.variants(df), *COLUMNS) == [("letters", 2, 0, None, None, "letters")]
    with pytest.raises(ValueError):
        spelling.variants(df, min_letters=1)
    with pytest.raises(ValueError):
        spelling.variants(df, ratio=1)
    with pytest.raises(ValueError):
        spelling.variants(df.drop("text"))
