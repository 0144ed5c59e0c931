"""Token files: the codec, the encoder against the tokenizers library, and round trips."""

import heapq
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpus_cases import documents, sentence
from stratus.llm import text_ids, token_output
from stratus.llm.huffman import Code, code_lengths
from stratus.session import shared_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def huffman_cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10 ** 6), min_size=1, max_size=300), st.integers(0, 2 ** 31))
def test_code_is_prefix_free_limited_and_round_trips(counts, seed):
    counts = np.array(counts)
    lengths = code_lengths(counts, 12)
    used = np.flatnonzero(counts)
    assert (lengths > 0).sum() == len(used) and lengths.max(initial=0) <= 12
    assert sum(2.0 ** -int(x) for x in lengths[used]) <= 1.0
    if len(used) > 1 and code_lengths(counts, 30).max() <= 12:
        assert int((counts * lengths.astype(int)).sum()) == huffman_cost(counts.tolist())
    if not len(used):
        return
    rng, code = np.random.default_rng(seed), Code(lengths)
    parts = [rng.choice(used, n) for n in (0, 1, 63, 64, 65, 700)]
    blocks = [(*code.encode(p), len(p)) for p in parts]
    assert np.array_equal(code.decode(blocks), np.concatenate(parts))
    assert np.array_equal(code.decode(blocks[3:4]), parts[3])


def test_more_symbols_than_the_limit_holds_get_longer_codes():
    assert code_lengths(np.ones(9), 3).max() == 4
    rng = np.random.default_rng(3)
    counts = np.concatenate([np.ones(70_000, np.int64), rng.integers(1, 10 ** 9, 200_000)])
    lengths = code_lengths(counts)
    assert lengths.max() == 19 and sum(2.0 ** -lengths[lengths > 0].astype(float)) <= 1.0
    code, ids = Code(lengths), rng.integers(0, len(counts), 5000)
    assert np.array_equal(code.decode([(*code.encode(ids), len(ids))]), ids)


PIECES = ["a", "Bc", "é", "ß", " ", "  ", "\n", "\t", "'s", "'", "'re", ".", "<|endoftext|>", "1", "²", "ő", "漢", "\x1c", "\xa0",
          "!", "don't", "_", "½", " ", "😀", "-", "foo", "BAR"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES) | st.characters(exclude_categories=["Cs"]), max_size=14).map("".join))
def test_encoder_equals_the_library(text):
    own = text_ids.token_ids(text_ids.read_spec(PATH))
    assert own.chunked
    want = TOKENIZER.encode(text, add_special_tokens=False).ids
    ids, offsets = own.encode(pa.array(["é", None, text, "", "x y"])[1:])
    assert ids[offsets[1]:offsets[2]].tolist() == want and offsets[1] == 0 and offsets[3] == offsets[2]
    ended, at = text_ids.with_end(ids, offsets, 7)
    assert ended[at[1]:at[2]].tolist() == [*want, 7] and ended[at[0]:at[1]].tolist() == [7] == ended[at[2]:at[3]].tolist()


def test_windows_cut_no_chunk(monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(40))) for _ in range(300)] + ["x" * 500]
    own = text_ids.TokenIds(text_ids.read_spec(PATH))
    monkeypatch.setattr(text_ids, "WINDOW_BYTES", 29)
    monkeypatch.setattr(text_ids, "CACHED_CHUNKS", 50)
    ids, offsets = own.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [
        TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    own = text_ids.TokenIds(text_ids.read_spec(path))
    text = "Hello  THERE,\nyou're 12"
    assert not own.chunked
    assert own.encode(pa.array([text]))[0].tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_round_trip(spark):
    rng = random.Random(8)
    rows = [(i, sentence(rng, rng.randrange(1, 200)), "en", "s") for i in rng.sample(range(10 ** 15), 40)]
    rows += [(7, None, None, None), (8, "", "en", "s"), (9, " \n", "en", "s"), (None, "nobody", "en", "s"),
             (11, sentence(rng, 60000), "en", "s"), (12, "twice", "en", "s"), (12, "twice", "en", "s"), (12, "thrice", "en", "s"),
             (13, "a <|endoftext|> b", "en", "s"), (-5, "minus", "en", "s")]
    path = shared_dir(spark, "test-tokens")
    token_output.write(documents(spark, rows).repartition(5), path, PATH, block_tokens=500)
    got = token_output.read(spark, path, with_ids=True).orderBy("start").collect()
    want = {}
    for doc_id, text, *_ in rows:
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]
        want.setdefault(doc_id, []).append(ids)
    order = sorted(want, key=lambda k: (k is not None, k or 0))
    assert [r.doc_id for r in got] == [k for k in order for _ in want[k]]
    at = 0
    for r in got:
        assert list(r.ids) in want[r.doc_id]
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        at += r.n_tokens
    assert sorted(map(tuple, want[12])) == sorted(tuple(r.ids) for r in got if r.doc_id == 12)


def test_empty_table(spark):
    path = shared_dir(spark, "test-tokens")
    token_output.write(documents(spark, [(1, "x", "en", "s")]).limit(0), path, PATH)
    assert token_output.read(spark, path).count() == 0


def test_a_worker_holds_little_beside_its_batch():
    own = text_ids.TokenIds(text_ids.read_spec(PATH))
    texts = pa.array(["some words that come again and again, " * 200] * 1300)  # 10 MB
    own.encode(texts.slice(0, 1))
    tracemalloc.start()
    try:
        own.encode(texts)
        assert tracemalloc.get_traced_memory()[1] < 100 << 20
    finally:
        tracemalloc.stop()


def test_kept_chunks_replace_one_another(monkeypatch):
    monkeypatch.setattr(text_ids, "PLACES", 64)
    rng = random.Random(9)
    pieces = [*PIECES, "\0", "\0\0", "a\0", "abcdefghijklmn", "abcdefghijklmno", "Zqxjkvbz"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(200)]
    own = text_ids.TokenIds(text_ids.read_spec(PATH))
    want = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
    for i in range(0, 200, 20):
        for _ in range(2):  # the second time from what was kept
            ids, offsets = own.encode(pa.array(texts[i:i + 20]))
            assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want[i:i + 20]


def test_kept_chunks_take_little_memory(monkeypatch):
    monkeypatch.setattr(text_ids, "PLACES", 1 << 17, raising=False)
    rng = random.Random(10)
    words = ["".join(rng.choices("aeioubdgklmnprst", k=7)) for _ in range(100_000)]
    spec = text_ids.read_spec(PATH)
    tracemalloc.start()
    try:
        own = text_ids.TokenIds(spec)
        own.encode(pa.array([" ".join(words)]))
        assert tracemalloc.get_traced_memory()[0] < 8 << 20
    finally:
        tracemalloc.stop()
