"""License scans: editions of one text agree, other texts do not."""

import re
import textwrap
from pathlib import Path

from corpus_cases import documents
from stratus.llm import licenses
from stratus.llm.license_texts import LICENSES, NOTICES, files


def test_scan(spark):
    mit = LICENSES["MIT"]
    other = ("# Copyright (c) 2020 Some One\n# All rights reserved.\n#\n" + "\n".join("#   " + x for x in mit.split("\n"))
             ).replace("sublicense", "SUBLICENCE").replace('"', "'").replace("OR COPYRIGHT HOLDERS", "or copyright OWNER" + "s").replace("OWNERs", "holders")
    rows = [(i, t, "en", "s") for i, t in enumerate(LICENSES.values())]
    rows += [(100, other, "en", "s"), (101, mit + " And more.", "en", "s"), (102, None, None, None), (103, "", "en", "s"),
             (104, "Copyright 2020 Nobody", "en", "s"), (105, "Some prose.\nreleased under the MIT LICENCE!\nmore\r\nLicensed under CC BY-NC 4.0.\r\n", "en", "s"),
             (106, "it is released under the MIT License.", "en", "s"), (107, "word " * 40000, "en", "s"), (None, mit, "en", "s"),
             (108, mit, "en", "s"), (108, mit, "en", "s"), (109, NOTICES[0][0], "en", "s"), (110, "ÉÀ ünicode", "fr", "s")]
    df = documents(spark, rows)
    got = licenses.scan(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].license_id for i in range(len(LICENSES))] == list(LICENSES)
    assert by[100].license_id == by[None].license_id == by[108].license_id == "MIT" and by[100].text_digest == by[0].text_digest
    assert all(by[i].license_id is None for i in (101, 102, 103, 104, 105, 106, 107))
    assert by[105].line_licenses == ["CC-BY-NC-4.0", "MIT"] and by[106].line_licenses == []
    assert by[109].license_id == "MIT" and by[109].line_licenses == ["MIT"]
    assert by[102].n_words == by[103].n_words == by[104].n_words == 0 and by[107].n_words == 40000
    assert licenses.scan(df.limit(0)).count() == 0


def test_every_spelling_is_levelled(spark):
    rows = [(a, b) for a, b in licenses.SPELLINGS]
    df = spark.createDataFrame([(f"x {a} y", f"X, {b.upper()}; y") for a, b in rows], "a string, b string")
    for r in df.select(licenses.normalise(df.a).alias("a"), licenses.normalise(df.b).alias("b")).collect():
        assert r.a == r.b


def test_ids_of_one_digest(spark):
    table = spark.createDataFrame([("L2", "some licence text"), ("L1", "Some license text!")], "license_id string, text string")
    table = table.select(licenses.digest(table.text).alias("license_digest"), "license_id")
    got = licenses.scan(documents(spark, [(1, "SOME LICENSE TEXT", "en", "s")]), table).first()
    assert got.license_id == "L1" and got.line_licenses == ["L1", "L2"]


def test_long_texts_and_titles(spark):
    folder = Path(licenses.__file__).parent / "license_files"
    long = {f.name.removesuffix(".txt"): f.read_text() for f in folder.iterdir()}
    assert {"Apache-2.0", "GPL-1.0-only", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.0-only", "LGPL-2.1-only", "LGPL-3.0-only",
            "MPL-1.1", "MPL-2.0", "CC0-1.0"} <= set(long)
    want = [(text, i) for i, text in long.items()]
    want += [("\n".join(" * " + x for x in text.upper().split("\n")), i) for i, text in long.items()]
    want += [(long[i].split("END OF TERMS")[0], i) for i in ("Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only")]
    want += [(f"{title}\n\nCopyright (c) 2021 Some One\n\n{LICENSES[i]}", i) for title, i in (
        ("The MIT License (MIT)", "MIT"), ("BSD 3-Clause License", "BSD-3-Clause"), ("ISC License", "ISC"))]
    want += [(long["Apache-2.0"] + "\nAnd more.", None), (long["GPL-3.0-only"].replace("freedom", "liberty", 1), None)]
    got = {r.doc_id: r.license_id for r in licenses.scan(documents(spark, [(n, t, "en", "s") for n, (t, _) in enumerate(want)])).collect()}
    assert [got[n] for n in range(len(want))] == [i for _, i in want]


def test_every_text_is_found_at_any_width(spark):
    """Paragraphs joined and broken again at 40 to 120 columns; holders and years of one's own."""
    claim = "Copyright (c) 2019-2024 The Authors of a Rather Long Named Project and all of its Contributors. All rights reserved."
    texts = [(i, claim + "\n\n" + t) for i, t in LICENSES.items()] + files()
    rows, want = [], {}
    for i, text in texts:
        paragraphs = re.split(r"\n[ \t]*\n", text)
        for width in range(40, 121, 8 if len(text) < 5000 else 40):
            wrapped = "\n\n".join(textwrap.fill(" ".join(p.split()), width) for p in paragraphs)
            want[len(rows)] = (i, width)
            rows.append((len(rows), wrapped, "en", "s"))
    got = {r.doc_id: r.license_id for r in licenses.scan(documents(spark, rows)).collect()}
    assert [w for n, w in want.items() if got[n] != w[0]] == []


def test_lines_without_the_word_license_and_body_lines(spark):
    isc = " ".join(LICENSES["ISC"].split())
    body = "Copyright holders be liable for any claim.\n(c) You must retain the notices.\ncopyright notice and this list"
    rows = [(1, f"intro\n{isc}\noutro", "en", "s"), (2, body, "en", "s"), (3, "x\nany words at all!\ny", "en", "s")]
    got = {r.doc_id: r for r in licenses.scan(documents(spark, rows)).collect()}
    assert got[2].n_words == len(re.findall(r"\w+", body))
    own = spark.createDataFrame([("own", "Any words at all")], "license_id string, text string")
    own = own.select(licenses.digest(own.text).alias("license_digest"), "license_id")
    assert {r.doc_id: r.line_licenses for r in licenses.scan(documents(spark, rows), own).collect()} == {1: [], 2: [], 3: ["own"]}
    assert got[1].line_licenses == ["ISC"]
