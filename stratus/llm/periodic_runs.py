"""Periodic runs of words, by a dictionary of basic factors.

A run is a maximal stretch of words with a smallest period q that repeats at
least three times. For each power of two the dictionary names the factors of
that many words (a pair of names of half the length), so equal factors have
equal names. A factor of length f whose next occurrence in the document begins
d words later, f <= d < 2f, proposes the period d there; neighbouring
proposals of one period are one arithmetic progression and count once. Every
run is proposed: among the rotations of its period one has a factor of length f
> q/2 (f the power of two at most q) that stands once in the period, so its
next occurrence is q words on; as the run holds three periods, both lie within
it. Proposals are extended in both directions; equal stretches are one run,
with their smallest period.

Only factors that occur twice in their document are named at the next power, so
on prose the dictionary ends after two or three. Documents are handled
``CHUNK_WORDS`` at a time or one longer text, as one sequence with a separator
after each.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import require, ship

MIN_LENGTH, MIN_PERIODS = 24, 3
CHUNK_WORDS = 1 << 18
#: Words of a proposal that are compared at once, before it is extended.
LOOK_AHEAD = 32
RUNS = "array<struct<start: long, length: long, period: long>>"


def _by_name(name: np.ndarray, pos: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(names, positions) ordered by name, then position."""
    shift = int(n).bit_length()
    if int(name.max()).bit_length() + shift < 63:  # one number holds both
        key = np.sort((name << shift) | pos)
        return key >> shift, key & ((1 << shift) - 1)
    order = np.lexsort((pos, name))
    return name[order], pos[order]


def _proposals(word: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, periods) for each power of two."""
    n, size = len(word), 1
    pos = np.flatnonzero(word >= 0)
    name = word[pos]
    while len(pos):
        name, pos = _by_name(name, pos, n)
        again = (name[1:] == name[:-1]) & (doc[pos[1:]] == doc[pos[:-1]])
        step = pos[1:] - pos[:-1]
        near = again & (step >= size) & (step < 2 * size)
        if near.any():
            period = np.zeros(n + 1, dtype=np.int64)
            period[pos[:-1][near]] = step[near]
            at = np.flatnonzero(period)
            at = at[period[at] != period[at - 1]]  # position 0 looks at the unused last cell
            yield at, period[at]
        twice = np.zeros(len(pos), dtype=bool)
        twice[1:] |= again
        twice[:-1] |= again
        rank = np.cumsum(np.concatenate([[0], name[1:] != name[:-1]]))
        named = np.full(n + size, -1, dtype=np.int64)
        named[pos[twice]] = rank[twice]
        pos = np.flatnonzero(named[:n] >= 0)
        pos = pos[(named[pos + size] >= 0)]
        pos = pos[doc[pos] == doc[pos + size]]
        name = named[pos] * (int(rank[-1]) + 1) + named[pos + size]
        size *= 2


def _extent(word: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """First and last + 1 of the positions around ``at`` that equal the one ``period`` on."""
    low = high = at
    step, last = 64, len(word) - period
    while high < last:
        stop = min(high + step, last)
        differs = np.flatnonzero(word[high:stop] != word[high + period:stop + period])
        if len(differs):
            high += int(differs[0])
            break
        high, step = stop, min(2 * step, 1 << 16)
    step = 64
    while low > 0:
        stop = max(low - step, 0)
        differs = np.flatnonzero(word[stop:low] != word[stop + period:low + period])
        if len(differs):
            low = stop + int(differs[-1]) + 1
            break
        low, step = stop, min(2 * step, 1 << 16)
    return low, high


def find_runs(word: np.ndarray, doc: np.ndarray, min_length: int = MIN_LENGTH,
              min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start. ``word`` holds the numbers of
    the words, documents ended by separators that occur once and are negative;
    ``doc`` the document of each position."""
    if min_periods < 3:
        raise ValueError("runs of fewer than three periods are not all proposed")
    found: dict[tuple[int, int], int] = {}
    for at, period in _proposals(word, doc):
        least = np.maximum(min_length, min_periods * period) - 2 * period + 1
        for j in range(LOOK_AHEAD):
            right = np.minimum(at + period + j, len(word) - 1)
            on = (j >= least) | (word[right - period] == word[right])
            at, period, least = at[on], period[on], least[on]
        known, until = 0, -1
        for i in np.lexsort((at, period)):
            q, place = int(period[i]), int(at[i])
            if q == known and place < until:
                continue
            low, high = _extent(word, place, q)
            known, until = q, high
            length = high - low + q
            if length >= max(min_length, min_periods * q):
                key = (low, length)
                found[key] = min(found.get(key, q), q)
    return sorted((start, length, q) for (start, length), q in found.items())


def _rows(texts: list[list[bytes]], min_length: int, min_periods: int) -> pd.DataFrame:
    number: dict[bytes, int] = defaultdict(itertools.count().__next__)
    sizes = [len(w) for w in texts]
    begin = np.cumsum([0, *(n + 1 for n in sizes)])
    word = np.empty(begin[-1], dtype=np.int64)
    for k, (a, words) in enumerate(zip(begin, texts)):
        word[a:a + len(words)] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        word[a + len(words)] = -1 - k
    doc = np.repeat(np.arange(len(texts)), np.diff(begin))
    runs: list[list[dict]] = [[] for _ in texts]
    for start, length, q in find_runs(word, doc, min_length, min_periods):
        k = int(doc[start])
        runs[k].append({"start": int(start - begin[k]), "length": length, "period": q})
    collapsed = []
    for words, own in zip(texts, runs):
        if own:
            kept = np.ones(len(words), dtype=bool)
            for r in own:
                kept[r["start"] + r["period"]:r["start"] + r["length"]] = False
            words = itertools.compress(words, kept)
        collapsed.append(b" ".join(words).decode("utf-8"))
    return pd.DataFrame({"n_words": sizes, "runs": runs, "collapsed": collapsed})


def _finder(min_length: int, min_periods: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            held, size, first = [], 0, 0
            for i, text in enumerate(pdf["text"]):
                # bytes.split() parts at blank and TAB..CR, no others
                words = [] if text is None else text.encode("utf-8").split()
                if held and size + len(words) > CHUNK_WORDS:
                    yield _rows(held, min_length, min_periods).assign(id=pdf["id"].to_numpy()[first:i])
                    held, size, first = [], 0, i
                held.append(words)
                size += len(words)
            if held:
                yield _rows(held, min_length, min_periods).assign(id=pdf["id"].to_numpy()[first:])
    return run


def find(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
         min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """One row per row of ``docs``: the id (as text, in ``id``), n_words, runs (by
    start, word numbers from 0), collapsed (the words joined by one space, of
    each run only the first period).

    Words are what stands between blanks and TAB..CR. A null or empty text has
    no words, no runs and an empty ``collapsed``; null and repeated ids are kept
    as they are; other columns are not looked at; an empty table gives none.
    """
    require(docs, id_column, text_column)
    ship(docs.sparkSession)
    return docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text")).mapInPandas(
        _finder(min_length, min_periods), f"id string, n_words long, runs {RUNS}, collapsed string").select(
        "id", "n_words", "runs", "collapsed")


def strongest(runs: Column | str) -> Column:
    """The run of greatest length / period (ties: smallest start, then period); null if there is none."""
    def order(a: Column, b: Column) -> Column:
        more, less = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(more != less, F.when(more > less, -1).otherwise(1))
                .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
                .otherwise(F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)))
    return F.get(F.array_sort(runs, order), 0)
