"""Personal data: base rules against plain regular expressions, and what the trees add."""

import re

import pytest

from corpus_cases import documents
from stratus.llm import pii
from stratus.llm.boosting import Boosted

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute(text):
    text, digits = text or "", lambda m: re.sub("[^0-9]", "", m.group())
    return ([("email", *m.span()) for m in EMAIL.finditer(text)]
            + [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
            + [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
            + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15])


CARD_NO = "4465758382889437"
TEXTS = [
    "write to a.b@c.de, or x@y.z_q@r.st. end@dot.com.", "@@a@b.c@d.e", "é" * 30 + " ärger@müll.de ok@fine.org 😀 z@z.zz",
    "10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 0000255.1.1.1 1.2.3", f"card {CARD_NO} and 4465-7583-8288-9437, 4465 7583 8288 9438",
    "+1 (366) 555-9807 or +12 and +1234567890123456 +49 30 1234567", "1" * 5000 + " " + "9." * 3000 + "7",
    "a" * 4000 + "@", "x." * 2000 + "@" + "b." * 2000 + "c", "", None, "no data here\nat all",
    "mail me a b @ c.d", "+1(2)3 4-5.6 7 8 9 0 end", " ".join(f"u{i}@h{i}.org" for i in range(700)),
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "en", "s"), (None, TEXTS[0], None, None)]
    clean = [(1000 + i, f"some words 555-98{i % 10} then {10 ** 6 + i} {('call', 'so')[i % 2]} +1 (366) 555-{1000 + i} or {('pay', 'see')[i % 3 > 0]} {CARD_NO} "
                        f"at 10.0.{i}.2 or m{i}@mail.example.com and 12345678{i:04d}", "en", "s") for i in range(120)]
    joined = [(5000, f"call +1 (366) 555-9807 {CARD_NO} now", "en", "s"), (5001, f"pay {CARD_NO} 42 now", "en", "s")]
    rows += clean + joined
    return rows, pii.find(documents(spark, rows)).collect()


def test_base_rules(found):
    rows, got = found
    expected = sorted((str(i), tuple(brute(t))) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), tuple(map(tuple, r.base))) for r in got) == expected


def test_spans_hold_base_and_add_what_ran_together(found):
    rows, got = found
    for r in got:
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))
        order = [(pii.KINDS.index(s.kind), s.start, s.end) for s in r.spans]
        assert order == sorted(order)
    by_id = {r.doc_id: r for r in got}
    text = next(t for i, t, *_ in rows if i == 5000)
    added = {(s.kind, text[s.start:s.end]) for s in by_id[5000].spans}
    assert {("phone", "+1 (366) 555-9807"), ("card", CARD_NO)} <= added
    assert all(len(by_id[1000 + i].spans) == len(by_id[1000 + i].base) for i in range(120))


def test_empty_table_and_redaction(spark, found):
    rows, _ = found
    assert pii.find(documents(spark, rows).limit(0)).count() == 0
    out = {r.doc_id: r.text for r in pii.redact(documents(spark, rows[:15])).collect()}
    assert out[9] == "" and out[10] is None and out[0] == EMAIL.sub("[email]", TEXTS[0])


def test_boosting_separates_and_its_sql_agrees(spark):
    counts = [((a, b), 30 * (a > 2 and b <= 1), 30 * (not (a > 2 and b <= 1))) for a in range(6) for b in range(4)]
    model = Boosted().fit(counts)
    df = spark.createDataFrame([c[0] for c in counts], "a int, b int").selectExpr("a", "b", f"{model.sql(['a', 'b'])} as s")
    for r in df.collect():
        assert abs(r.s - model.score((r.a, r.b))) < 1e-9
        assert (r.s > 0.5) == (r.a > 2 and r.b <= 1)
    assert Boosted().fit([]).score((1, 2)) == 0.5


def test_thresholds_are_those_of_the_held_out_rows():
    assert pii.calibrate([(.95, 100, 0), (.92, 0, 50)]) == .95
    assert pii.calibrate([(.9, 100, 0), (.9, 0, 90)]) == pii.NEVER  # equal scores stand or fall together
    assert pii.calibrate([(.99, 0, 5), (.2, 0, 7)]) == pii.NEVER == pii.calibrate([])
    assert pii.calibrate([(.99, 40, 0), (.7, 0, 1), (.4, 60, 0), (.1, 0, 30)]) == .4
    assert pii.calibrate([(.3, 10, 0)]) == .3  # no floor


def test_the_fit_bound_cuts_no_calibration(spark, monkeypatch):
    """Vectors beyond the bound of the fit still count for the thresholds; null ids are dealt too."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(pii, "MAX_VECTORS", 3)
    seen = []
    kept = pii.calibrate
    monkeypatch.setattr(pii, "calibrate", lambda rows: seen.extend(rows) or kept(rows))
    rows = [(None, f"call +1 (366) 555-{1000 + i} or m{i}@mail.example.com {10 ** (6 + i % 4)} 10.0.{i}.2", "en", "s") for i in range(300)]
    df = documents(spark, rows)
    proposed = pii.stage(pii.propose(df), "test-pii")
    pii.fit(proposed)
    labelled = proposed.where(F.pmod(F.xxhash64("doc_id", "proposals"), F.lit(4)) == 0).selectExpr(
        "size(filter(proposals, x -> x.label is not null)) as n").agg(F.sum("n")).first()[0]
    assert sum(p + n for _, p, n in seen) == labelled > 100
