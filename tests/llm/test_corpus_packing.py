"""Packing: exchanges by hand, invariants, and pieces against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpus_cases import documents, sentence
from stratus.llm import packing
from stratus.llm.packing import Packer

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def packer(bins, length):
    sizes = [s for b in bins for s in b]
    own = Packer(sizes, length)
    number = iter(range(len(sizes)))
    own.bins = [[next(number) for _ in b] for b in bins]
    own.fill = [sum(b) for b in bins]
    return own


def filled(own):
    assert all(sum(own.sizes[i] for i in b) == f <= own.length for b, f in zip(own.bins, own.fill))
    assert sorted(i for b in own.bins for i in b) == list(range(len(own.sizes)))
    return sorted((f for f in own.fill if f), reverse=True)


@pytest.mark.parametrize("bins, want", [
    ([[7, 1], [2]], [10]),                       # a move empties a sequence
    ([[5, 3], [4, 1]], [10, 3]),                 # a move of 1, one for one 4 for 3
    ([[6, 3], [4, 4]], [10, 7]),                 # one for one
    ([[4, 3, 2], [6, 2]], [10, 7]),              # two for one: 3 + 2 for 6
    ([[5, 4], [3, 2, 3]], [10, 7]),              # one for two: 4 for 3 + 2
    ([[9], [9]], [9, 9]),                        # nothing to gain
])
def test_exchanges(bins, want):
    own = packer(bins, 10)
    own.search()
    assert filled(own) == want


def least(sizes, length):
    """Fewest sequences, by trying all."""
    best = len(sizes)

    def place(rest, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not rest:
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + rest[0] <= length:
                place(rest[1:], bins[:i] + [bins[i] + rest[0]] + bins[i + 1:])
        place(rest[1:], bins + [rest[0]])
    place(sorted(sizes, reverse=True), [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_search_never_loses_and_ends_near_the_optimum(sizes):
    own = Packer(sizes, 20)
    own.best_fit()
    squares, bins = sum(f * f for f in own.fill), len(own.bins)
    made = own.search()
    fills = filled(own)
    assert sum(f * f for f in fills) >= squares + made and len(fills) <= bins
    assert len(fills) <= least(sizes, 20) + 1


def test_search_ends_on_many_alike():
    rng = random.Random(2)
    sizes = [rng.randrange(30, 45) for _ in range(1500)]
    own = Packer(sizes, 100)
    own.best_fit()
    own.search()
    assert len(filled(own)) <= len(sizes) / 2
    assert own.search() == 0


def corpus():
    rng = random.Random(8)
    rows = [(i, sentence(rng, rng.randrange(1, 120)), "en", "s") for i in rng.sample(range(10 ** 15), 150)]
    return rows + [(7, None, None, None), (8, "", "en", "s"), (None, "nobody", "en", "s"), (11, sentence(rng, 9000), "en", "s"),
                   (12, "twice", "en", "s"), (12, "twice", "en", "s"), (12, "thrice", "en", "s"), (13, "a <|endoftext|> b", "en", "s")]


@pytest.mark.parametrize("length, group_items", [(64, 40), (64, 8192), (1, 100), (1024, 8192)])
def test_pieces_and_places(spark, length, group_items):
    rows = corpus() if length > 1 else corpus()[-8:]
    df = documents(spark, rows).repartition(3)
    packed = packing.pack(df, PATH, length=length, group_items=group_items, with_ids=True)
    got = packed.collect()
    want = sorted((r[0] is not None, r[0] or 0, TOKENIZER.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in rows)
    docs = {}
    for r in got:
        docs.setdefault((r.part, r.row), []).append(r)
    seen = []
    for pieces in docs.values():
        pieces.sort(key=lambda r: r.piece)
        ids = np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist()
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces[:-1])]).tolist()
        assert all(r.length == length for r in pieces[1:]) and 1 <= pieces[0].length <= length
        assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length for r in pieces)
        seen.append((pieces[0].doc_id is not None, pieces[0].doc_id or 0, ids))
    assert sorted(seen) == want
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [a for a, _ in own] == np.cumsum([0, *(n for _, n in own[:-1])]).tolist() and sum(n for _, n in own) <= length
    total = sum(r.length for r in got)
    assert len(places) <= -(-total // length) + (3 if group_items > 40 else 6)
    whole = packing.sequences(packed).collect()
    assert sorted(r.sequence_id for r in whole) == sorted(places)
    ids = {(r.doc_id, r.piece, r.ids_crc32): bytes(r.ids) for r in got}
    for r in whole:
        assert r.length * 4 == len(r.ids)
        for p in r.pieces:
            part = bytes(r.ids[4 * p.offset:4 * (p.offset + p.length)])
            assert ids[p.id, p.piece, zlib.crc32(part)] == part


def test_reruns_agree(spark):
    df = documents(spark, corpus()).coalesce(1)
    one, two = (sorted(map(str, packing.pack(df, PATH, length=64, group_items=40).collect())) for _ in range(2))
    assert one == two


def test_empty_table(spark):
    assert packing.pack(documents(spark, corpus()).limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(documents(spark, corpus()), PATH, length=0)
