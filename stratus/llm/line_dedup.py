"""Substring dedup by hashing lines, paragraphs or sentences.

A text is cut into units: its lines, and within a line its sentences, so that a
passage pasted into the middle of a paragraph is still found. Units are
normalised and hashed; per digest the earliest occurrence (by document id, then
place) is kept. Whole lines and whole paragraphs are units too, and every later
occurrence of one is removed, however short. A later sentence inside a line
that is otherwise new is removed when it stands in a run of repeated units that
holds at least ``min_words`` words: passages go, short sentences that writers
share by chance stay. Between sentences, repeated word runs of more than 50
words are found wherever they begin and end, and repeated runs are extended into
the units beside them (``word_runs``). What is removed is given as ranges of the
original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm import word_runs
from stratus.llm.common import require, stage

MIN_WORDS = 20
UNITS = {
    "sentence": re.compile(r"[^\n.!?]*(?:[.!?]+|\n|$)"),
    "line": re.compile(r"[^\n]*(?:\n|$)"),
    "paragraph": re.compile(r"(?:[^\n]|\n(?!\s*\n))*(?:\n\s*\n\s*|$)"),
}
_NOT_WORD = re.compile(r"[\W_]+")
_BLANK_LINE = re.compile(r"\n\s*\n")


def units(text: str, kind: str = "sentence") -> list[tuple[int, int, str]]:
    """(start, end, normalised) of the units of a text that hold a word; they do not overlap.

    Normalised: lower case, everything but letters and digits one blank.
    """
    out = []
    for m in UNITS[kind].finditer(text):
        norm = _NOT_WORD.sub(" ", m.group().lower()).strip()
        if norm:
            out.append((m.start(), m.end(), norm))
    return out


def _levels(text: str, kind: str) -> Iterator[tuple[int, int, int, int, str, bool]]:
    """(nth, n, start, end, normalised, whole) of the units, and of the lines and
    paragraphs that hold several of them (n units from the nth on).

    ``whole``: the unit is all the words of its line or paragraph.
    """
    found = units(text, kind)
    if kind != "sentence":
        yield from ((nth, 1, start, end, norm, True) for nth, (start, end, norm) in enumerate(found))
        return
    lines, paragraphs, last = [], [], 0  # lists of (first unit, units), of (first line, lines)
    for nth, (start, _, _) in enumerate(found):
        # The break may lie before the unit's words or between it and the unit before.
        between = text[last:start] if nth else "\n\n"
        if "\n" in between:
            if not nth or _BLANK_LINE.search(between):
                paragraphs.append([len(lines), 0])
            lines.append([nth, 0])
            paragraphs[-1][1] += 1
        lines[-1][1] += 1
        last = found[nth][1] - (text[found[nth][1] - 1] == "\n")
    for first, n in lines:
        for nth in range(first, first + n):
            yield nth, 1, *found[nth], n == 1
        if n > 1:
            yield first, n, found[first][0], found[first + n - 1][1], " ".join(x[2] for x in found[first:first + n]), True
    for first, n in paragraphs:
        if n > 1:
            a, b = lines[first][0], sum(lines[first + n - 1])
            yield a, b - a, found[a][0], found[b - 1][1], " ".join(x[2] for x in found[a:b]), True


def _cutter(kind: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["has_id", "doc_id", "text_hash", "nth", "n", "start", "end", "words", "whole"]

        def frame(keys: list, sizes: list, rows: list, digests: list) -> pd.DataFrame:
            d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            values = [*(np.repeat(np.array(c), sizes) for c in zip(*keys)), *map(np.array, zip(*rows))]
            return pd.DataFrame(dict(zip(columns, values)) | {"d1": d[:, 0], "d2": d[:, 1]})

        for pdf in batches:
            keys, sizes, rows, digests = [], [], [], []
            for *key, text in zip(*(pdf[c] for c in ("has_id", "doc_id", "text_hash", "text"))):
                before = len(rows)
                for nth, n, start, end, norm, whole in _levels(text or "", kind):
                    rows.append((nth, n, start, end, norm.count(" ") + 1, whole))
                    digests.append(blake2b(norm.encode("utf-8", "surrogatepass"), digest_size=16).digest())
                if len(rows) > before:
                    keys.append(key)
                    sizes.append(len(rows) - before)
                if len(rows) > 100_000:
                    yield frame(keys, sizes, rows, digests)
                    keys, sizes, rows, digests = [], [], [], []
            if rows:
                yield frame(keys, sizes, rows, digests)
    return run


def _runs(min_words: int):
    """Over rows sorted by document, place and length, longest first: ranges of
    runs of repeated units of enough words, and of the whole lines and paragraphs in other runs."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, out, doc = [], [], None  # at: pieces (next nth, n, start, end, words, whole) of the open run

        def close():
            enough = sum(p[4] for p in at) >= min_words
            for gone, pieces in groupby(at, key=lambda p: enough or p[5]):
                if gone:
                    pieces = list(pieces)
                    out.append((*doc, pieces[0][2], pieces[-1][3], sum(p[1] for p in pieces), sum(p[4] for p in pieces)))
            at.clear()

        for pdf in batches:
            for has_id, doc_id, text_hash, nth, n, start, end, words, whole in pdf.itertuples(index=False, name=None):
                same = (has_id, doc_id, text_hash) == doc
                if at and same and nth < at[-1][0]:
                    continue  # inside a line or paragraph that is repeated as a whole
                if not (at and same and nth == at[-1][0]):
                    close()
                    doc = (has_id, doc_id, text_hash)
                at.append((nth + n, n, start, end, words, whole))
            yield pd.DataFrame(out, columns=["has_id", "doc_id", "text_hash", "start", "end", "units", "words"])
            out = []
        close()
        yield pd.DataFrame(out, columns=["has_id", "doc_id", "text_hash", "start", "end", "units", "words"])
    return run


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over rows sorted by document: its ranges of units and of word runs as ranges apart from each other."""
    columns = ["has_id", "doc_id", "text_hash", "n_removed", "words_removed", "removed"]
    doc, parts, out = None, [], []

    def close():
        if not parts:
            return
        whole = sorted(p[:2] for p in parts if p[4] is None)
        starts = np.unique(np.concatenate([np.empty(0, np.int64), *(p[4] for p in parts if p[4] is not None)]))
        if whole:
            at = np.searchsorted([a for a, _ in whole], starts, side="right") - 1
            starts = starts[(at < 0) | (starts >= np.array([b for _, b in whole])[at])]
        ranges = []
        for a, b in sorted(p[:2] for p in parts):
            if ranges and a <= ranges[-1]["end"] and (a < ranges[-1]["end"] or len(whole) < len(parts)):
                ranges[-1]["end"] = max(b, ranges[-1]["end"])
            else:
                ranges.append({"start": a, "end": b})
        out.append((*doc, sum(p[2] for p in parts), sum(p[3] for p in parts) + len(starts), ranges))
        parts.clear()

    for pdf in batches:
        for *key, start, end, n, words, starts in zip(*(pdf[c] for c in (*columns[:3], "start", "end", "units", "words", "starts"))):
            if key != doc:
                close()
                doc = key
            parts.append((start, end, n, words, starts))
        yield pd.DataFrame(out, columns=columns)
        out = []
    close()
    yield pd.DataFrame(out, columns=columns)


def find(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
         kind: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per distinct (id, text): doc_id, text_hash, n_units, n_removed,
    words_removed, removed (ranges of the text, start and end in code points, end exclusive).
    n_removed counts the units that go as such, words_removed also the words of other repeated runs.

    Null texts and texts without words have no units. Rows with a null id rank
    before all others. Rows that repeat both id and text are one document; a
    repeated id with another text is a document of its own, ranked by a hash of it.
    """
    require(docs, id_column, text_column)
    key = F.col(id_column).cast("long")
    rows = docs.select(key.isNotNull().alias("has_id"), F.coalesce(key, F.lit(0)).alias("doc_id"),
                       F.xxhash64(F.col(text_column)).alias("text_hash"), F.col(text_column).alias("text"))
    cut = stage(rows.mapInPandas(_cutter(kind), "has_id boolean, doc_id long, text_hash long, nth int, n int, start int, end int, "
                                                "words int, whole boolean, d1 long, d2 long"), "units")
    place = F.struct("has_id", "doc_id", "text_hash", "nth")
    # Only digests met at two places go on; the first place of each is kept.
    first = stage(cut.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                  .where("first <> last").select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), "first"), "unit-first")
    again = (cut.join(first, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2"))).where(place != F.col("first"))
             .select("has_id", "doc_id", "text_hash", "nth", "n", "start", "end", "words", "whole").distinct())
    order = ["has_id", "doc_id", "text_hash", "nth"]
    ranges = (again.repartition(*order[:3]).sortWithinPartitions(*order, F.desc("n"))
              .mapInPandas(_runs(min_words), "has_id boolean, doc_id long, text_hash long, start int, end int, units int, words int"))
    ranges = stage(ranges.withColumn("starts", F.lit(None).cast("array<int>")), "unit-ranges")
    if kind == "sentence":
        removed = ranges.groupBy(*order[:3]).agg(F.collect_list(F.struct("start", "end")).alias("removed"))
        runs = word_runs.find(rows, removed, min_words)
        ranges = ranges.unionByName(runs.withColumns({"units": F.lit(0), "words": F.lit(0)}))
    removed = ranges.repartition(*order[:3]).sortWithinPartitions(*order[:3]).mapInPandas(
        _merge, "has_id boolean, doc_id long, text_hash long, n_removed long, words_removed long, removed array<struct<start:int,end:int>>")
    removed = stage(removed, "unit-removed").withColumnsRenamed({c: f"r_{c}" for c in order[:3]})
    n = cut.groupBy(*order[:3]).agg((F.max("nth") + 1).alias("n_units"))
    all_docs = rows.select(*order[:3]).distinct()
    n = n.withColumnsRenamed({c: f"n_{c}" for c in order[:3]})

    def same(prefix: str):
        return ((F.col("has_id") == F.col(f"{prefix}_has_id")) & (F.col("doc_id") == F.col(f"{prefix}_doc_id"))
                & (F.col("text_hash") == F.col(f"{prefix}_text_hash")))
    return (all_docs.join(n, same("n"), "left").join(removed, same("r"), "left")
            .select(F.when(F.col("has_id"), F.col("doc_id")).alias("doc_id"), "text_hash",
                    F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"),
                    F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("words_removed", F.lit(0)).cast("long").alias("words_removed"),
                    F.coalesce("removed", F.array().cast("array<struct<start:int,end:int>>")).alias("removed")))


def remove(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` with the repeated passages cut out of the text; columns as they
    are, and all rows stay, those left without text with an empty one."""
    found = find(docs, id_column=id_column, text_column=text_column, **options).where("words_removed > 0").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("removed").alias("__removed"))
    found = stage(found, "unit-cuts")
    same = docs[id_column].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_column]) == F.col("__hash"))
    wide = docs.join(found, same, "left")
    cut = F.expr(f"aggregate(__removed, named_struct('at', 0, 'out', ''), (a, x) -> named_struct('at', x.end, 'out', "
                 f"concat(a.out, substr(`{text_column}`, a.at + 1, x.start - a.at))), "
                 f"a -> concat(a.out, substr(`{text_column}`, a.at + 1)))")
    return wide.select(*[F.when(F.col("__removed").isNotNull(), cut).otherwise(docs[c]).alias(c)
                         if c == text_column else docs[c] for c in docs.columns])
