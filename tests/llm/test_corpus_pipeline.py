"""The pipeline's stages, each against its own input."""

import collections
import os
import re
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from stratus.llm.common import stage  # noqa: E402
from test_corpus_decontamination import brute as contaminated  # noqa: E402
from test_corpus_lsh_forest import brute as groups  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], SF), "test-pipeline"))
    return [t.collect() for t in out], [t.columns for t in out]


def test_columns_and_order(tables):
    _, columns = tables
    assert all(c == columns[0] for c in columns[1:5])
    assert [n.split()[0] for n, _ in corpus_pipeline.STAGES] == ["language", "MinHash", "benchmark", "mixing", "token-ID"]


def test_language_stage_keeps_texts(tables):
    rows, _ = tables
    gone = {r.doc_id for r in rows[0]} - {r.doc_id for r in rows[1]}
    assert all(len((r.text or "").split()) < 3 or not re.search(r"[^\W\d_]", r.text) for r in rows[0] if r.doc_id in gone)


def test_near_duplicates_stage(tables):
    rows, _ = tables
    want = {d for d, _, c in groups([(r.doc_id, r.text) for r in rows[1]], 5) if d == c}
    assert {r.doc_id for r in rows[2]} == want and len(rows[2]) == len(want) < len(rows[1])


def test_decontamination_stage(spark, tables):
    rows, _ = tables
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in contaminated([(r.doc_id, r.text) for r in rows[2]], items) if r[4]}
    assert {r.doc_id for r in rows[3]} == {r.doc_id for r in rows[2]} - bad and bad


def test_mixing_stage(tables):
    rows, _ = tables
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    taken = collections.Counter(r.doc_id for r in rows[4])
    assert max(taken.values()) <= 2 and set(taken) <= {r.doc_id for r in rows[3]}
    total, mixed = sum(map(size, rows[3])), sum(map(size, rows[4]))
    assert abs(mixed - 1.5 * total) < 0.05 * total


def test_token_stage(tables):
    rows, _ = tables
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at = 0
    texts = {r.doc_id: r.text for r in rows[4]}
    assert sorted(r.doc_id for r in rows[5]) == sorted(r.doc_id for r in rows[4])
    for r in sorted(rows[5], key=lambda r: r.start):
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)


def test_run_gives_the_last_stage(spark, tables):
    rows, _ = tables
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, rows[5]))
