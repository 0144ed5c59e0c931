"""Repeated word runs whose ends fall anywhere, for substring dedup.

Of every SPREAD windows of WINDOW words in a row, the one of smallest hash is an
anchor (winnowing: which one depends on these words alone), so two places that
share PASSAGE words share an anchor. Per anchor hash the earliest place is kept;
each later place is compared with it word by word, CONTEXT words to both sides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import bounded, stage

WINDOW = 12
SPREAD = 40
PASSAGE = WINDOW + SPREAD - 1
CONTEXT = SPREAD
TAIL = 3
KEY = ["has_id", "doc_id", "text_hash"]
_KEY = "has_id boolean, doc_id long, text_hash long"
_WORD = re.compile(r"[^\W_]+")
_BREAK = re.compile(r"[.!?\n]")
_END = re.compile(r"[.!?]*")
_BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: whether it is of a word, and 64 bits for its lower case."""
    chars = [chr(i) for i in range(0x110000)]
    lower = np.fromiter((ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in chars), np.uint64, len(chars))
    lower[ord("ς")] = ord("σ")
    return np.fromiter((c.isalnum() for c in chars), np.int8, len(chars)), _mix((lower + np.uint64(1)) * np.uint64(_BASE))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _BASE and of its inverse modulo 2^64."""
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (in code points) and 64-bit hashes of the words of a text."""
    word, bits = _letters()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    inside = word[codes]
    edges = np.flatnonzero(np.diff(inside, prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, ends, np.empty(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    letters = bits[codes[inside.view(bool)]]
    letters *= _powers(1024)[0][(np.arange(len(letters)) - np.repeat(first, sizes)) & 1023]
    return starts, ends, _mix(np.add.reduceat(letters, first))


def _sliding(f: np.ufunc, x: np.ndarray) -> np.ndarray:
    """``f`` of each SPREAD values in a row."""
    n = 1
    while 2 * n <= SPREAD:
        x = f(x[:-n], x[n:])
        n *= 2
    return f(x[:n - SPREAD], x[SPREAD - n:]) if n < SPREAD else x


def anchors(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (word numbers) and 64-bit hashes of the anchors of a text, from the hashes of its words."""
    if len(h) < PASSAGE:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    up, down = _powers(1 << (len(h) - 1).bit_length())
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[:len(h)], dtype=np.uint64)])
    h = (sums[WINDOW:] - sums[:-WINDOW]) * down[:len(h) - WINDOW + 1]
    h = _mix(h)
    # Smallest of some SPREAD in a row: equal to the largest of the minima of those that hold it.
    low = _sliding(np.minimum, h)
    low = np.concatenate([np.zeros(SPREAD - 1, np.uint64), low, np.zeros(SPREAD - 1, np.uint64)])
    at = np.flatnonzero(_sliding(np.maximum, low) == h)
    # Of one word repeated on and on, the first.
    at = at[np.concatenate([[True], (np.diff(at) > 1) | (h[at[1:]] != h[at[:-1]])])]
    return at, h[at].view(np.int64)


def _finder(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for has_id, doc_id, text_hash, text in zip(*(pdf[c] for c in (*KEY, "text"))):
            starts, ends, h = words(text or "")
            at, h = anchors(h)
            if len(at):
                out.append((has_id, doc_id, text_hash, len(at), starts[at], starts[np.maximum(at - CONTEXT, 0)],
                            ends[np.minimum(at + WINDOW + CONTEXT, len(ends)) - 1], h))
        if out:
            n = [x[3] for x in out]
            yield pd.DataFrame({c: np.repeat([x[i] for x in out], n) for i, c in enumerate(KEY)} | {
                c: np.concatenate([x[i] for x in out]) for i, c in ((4, "start"), (5, "lo"), (6, "hi"), (7, "h"))})


def _slicer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The text around each wanted place, with the marks that end its last sentence."""
    columns = [*KEY, "kept", "h", "start", "lo", "part"]
    for pdf in batches:
        out = []
        for has_id, doc_id, text_hash, text, wanted in zip(*(pdf[c] for c in (*KEY, "text", "wanted"))):
            for w in wanted:
                out.append((has_id, doc_id, text_hash, w["kept"], w["h"], w["start"], w["lo"],
                            text[w["lo"]:_END.match(text, w["hi"]).end()]))
        yield pd.DataFrame(out, columns=columns)


def _split(part: str, at: int) -> tuple[list[str], list[re.Match], int]:
    """Lower-case words of a slice, their matches, and the number of the word that starts at ``at``."""
    found = list(_WORD.finditer(part))
    return [m.group().lower() for m in found], found, next(i for i, m in enumerate(found) if m.start() == at)


def _without_tails(part: str, found: list[re.Match], a: int, b: int) -> tuple[int, int]:
    """Words a to b without fewer than TAIL words of a sentence that goes on outside: such are shared by chance."""
    breaks = [k == 0 or k == len(found) or bool(_BREAK.search(part, found[k - 1].end(), found[k].start()))
              for k in range(len(found) + 1)]
    if not breaks[b]:
        b = next((k for k in range(b - 1, max(a, b - TAIL), -1) if breaks[k]), b)
    if not breaks[a]:
        a = next((k for k in range(a + 1, min(b, a + TAIL)) if breaks[k]), a)
    return a, b


def _comparer(min_words: int):
    """Ranges of the later place that equal the kept one word by word, and the starts of their words."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [*KEY, "start", "end", "starts"]
        for pdf in batches:
            out = []
            for *key, start, lo, part, k_at, k_part in zip(*(pdf[c] for c in (*KEY, "start", "lo", "part", "k_at", "k_part"))):
                own, found, i = _split(part, start - lo)
                others, _, j = _split(k_part, k_at)
                a = b = 0
                while b < len(own) - i and b < len(others) - j and own[i + b] == others[j + b]:
                    b += 1
                while a < i and a < j and own[i - a - 1] == others[j - a - 1]:
                    a += 1
                if b < WINDOW:
                    continue
                a, b = _without_tails(part, found, i - a, i + b)
                # A few words repeated on and on are no passage.
                if b - a >= min_words and 2 * len(set(own[a:b])) >= min_words:
                    out.append((*key, lo + found[a].start(), lo + _END.match(part, found[b - 1].end()).end(),
                                [lo + m.start() for m in found[a:b]]))
            yield pd.DataFrame(out, columns=columns)
    return run


def on(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join of two tables by KEY, with the columns of ``left`` first."""
    other = right.withColumnsRenamed({c: f"__{c}" for c in KEY})
    same = (F.col("has_id") == F.col("__has_id")) & (F.col("doc_id") == F.col("__doc_id")) & (F.col("text_hash") == F.col("__text_hash"))
    return left.join(other, same, how).drop(*[f"__{c}" for c in KEY])


def find(rows: DataFrame, removed: DataFrame, min_words: int) -> DataFrame:
    """has_id, doc_id, text_hash, start, end, starts: passages met before, as
    ranges of the text and the starts of their words; they may overlap.

    ``rows``: KEY and text. ``removed``: KEY and the ranges that go anyway;
    places whose surroundings lie inside one of them are not looked at.
    """
    found = stage(rows.mapInPandas(_finder, f"{_KEY}, start int, lo int, hi int, h long"), "anchors")
    again = found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select(F.col("h").alias("again"))
    met = stage(found.join(stage(again, "anchors-again"), F.col("h") == F.col("again")).drop("again"), "anchors-met")
    place = F.struct(*KEY, "start")
    first = met.groupBy("h").agg(F.min(F.struct(*KEY, "start", "lo", "hi")).alias("first")).select(F.col("h").alias("k_h"), "first")
    first = stage(first, "anchors-first")
    later = met.join(first, F.col("h") == F.col("k_h")).where(place != F.struct(*[F.col(f"first.{c}") for c in (*KEY, "start")]))
    inside = F.exists("removed", lambda x: (x["start"] <= F.col("lo")) & (x["end"] >= F.col("hi")))
    later = on(later.drop("k_h", "first"), removed.select(*KEY, "removed"), "left").where(~F.coalesce(inside, F.lit(False)))
    later = stage(later.drop("removed"), "anchors-later").distinct()
    needed = later.select("h").distinct().withColumnRenamed("h", "n_h")
    kept = first.join(needed, F.col("k_h") == F.col("n_h")).select("first.*", F.col("k_h").alias("h"))
    one = F.struct("kept", "h", "start", "lo", "hi")
    wanted = later.withColumn("kept", F.lit(False)).unionByName(kept.withColumn("kept", F.lit(True)))
    wanted = stage(wanted.groupBy(*KEY).agg(F.collect_list(one).alias("wanted")), "anchors-wanted")
    # Only texts with a wanted place are dealt out; rows that repeat id and text give the same slices.
    some = on(rows, bounded(wanted.select(*KEY)), "left_semi").dropDuplicates(KEY)
    slices = stage(on(some, wanted, "inner").mapInPandas(
        _slicer, f"{_KEY}, kept boolean, h long, start int, lo int, part string"), "anchors-slices")
    kept = slices.where("kept").select(F.col("h").alias("k_h"), (F.col("start") - F.col("lo")).alias("k_at"), F.col("part").alias("k_part"))
    pairs = slices.where("not kept").join(kept, F.col("h") == F.col("k_h")).select(*KEY, "start", "lo", "part", "k_at", "k_part")
    return pairs.mapInPandas(_comparer(min_words), f"{_KEY}, start int, end int, starts array<int>")
