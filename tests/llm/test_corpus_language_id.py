"""Language identification: held-out accuracy, rows without language, gradients."""

import zlib

import numpy as np
import pytest

from corpus_cases import documents
from stratus.llm import language_id as L

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def predicted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs.select("doc_id", "lang").join(L.identify(docs), "doc_id").collect()


def test_held_out_accuracy(predicted):
    held = [r for r in predicted if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in predicted if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert len(held) > 150 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in predicted)


def test_rows_without_language(spark):
    rows = [(i, f"the quick brown fox number {i} was here" if i % 2 else f"schöne grüße aus köln und {i} tschüß", "en" if i % 2 else "de", "s")
            for i in range(200)]
    rows += [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "12 !? \n", "de", "s"), (1003, "the fox was here " * 4000, None, None),
             (None, "the fox", "en", "s"), (5, "the fox again", "en", "s"), (5, "the fox again", "en", "s")]
    df = documents(spark, rows)
    got = L.identify(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1001].score == 0.0
    assert by[1003].lang_pred == "en" and by[1003].score > 0.9 and not by[None].held_out
    kept = L.keep_identified(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r[0] for r in rows} - {1000, 1001, 1002}


def test_nothing_to_learn(spark):
    rows = [(i, "some text", None, "s") for i in range(5)]
    assert {r.lang_pred for r in L.identify(documents(spark, rows)).collect()} == {"und"}
    assert L.identify(documents(spark, rows).limit(0)).count() == 0


def test_labels_and_ids_are_no_inputs():
    """The prediction is a function of the bytes alone, over all windows."""
    net = L.ByteNet(["a", "b"])
    texts = [b"", b"x" * 700, "é".encode() * 300, b"abc"]
    one = [net.predict([t]) for t in texts]
    all_ = net.predict(texts)
    assert np.allclose(all_[1], [p[0] for _, p in one], atol=1e-6)
    windows, used = L._bytes(texts)
    assert len(windows) == 1 + 3 + 3 + 1 and used.tolist() == [1, 256, 256, 188, 256, 256, 88, 3]


def test_gradients():
    rng = np.random.default_rng(0)
    net = L.ByteNet(["a", "b", "c"], seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    windows, y = rng.integers(0, 256, (5, L.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 0, 1])
    grads = net._gradients(windows, y)

    def loss():
        return -np.log(net._forward(windows)[3][np.arange(5), y]).mean()
    for k in net.p:
        at = np.unravel_index(np.abs(grads[k]).argmax(), grads[k].shape)
        old, step = net.p[k][at], 1e-5
        net.p[k][at] = old + step
        up = loss()
        net.p[k][at] = old - step
        down = loss()
        net.p[k][at] = old
        assert (up - down) / (2 * step) == pytest.approx(grads[k][at], rel=1e-3)
