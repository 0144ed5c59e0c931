"""Spelling variants: words one edit apart, grouped under their commonest form.

Near words are found by asymmetric chunks. The shorter word of a pair (or
either, at equal length) contributes two disjoint chunks, its first half and
the rest; the other contributes its positional grams of the chunks' lengths. One
edit falls into one chunk at most, so the other stands unchanged in the longer
word, at the same place or, behind an inserted letter, one further: only grams
at those two places are joined. What is left of both words beside the common
chunk again differs by one edit, so it is cut into chunks in the same way, and
the join is on both levels at once: three quarters of a word. Pairs that meet
are verified.

A group that still holds many pairs (words alike but for a few letters) is cut
further, until the open part has one letter; then every pair that meets is near
or almost. No group is dropped or cut off, and each level halves the open part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import require, ship, stage

MIN_LETTERS, MIN_COUNT, RATIO = 7, 2, 10
LETTERS = "A-Za-zÀ-ÿ"
#: Chunks that a pair must share at first; see GROUP_PAIRS.
LEVELS = 2
#: Pairs that meet in one group; a group of more is cut further.
GROUP_PAIRS = 50_000
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 500_000


def _counter(least: int, change: Callable | None):
    word = re.compile(f"[{LETTERS}]{{{least},}}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for pdf in batches:
            for doc, text in zip(pdf["id"], pdf["text"]):
                if not text:
                    continue
                lower = text.lower() if text.isascii() else text.encode("utf-8").lower().decode("utf-8")
                own = Counter(word.findall(lower))
                for w, n in own.items() if change is None else change(doc, own):
                    if len(w) >= least:
                        total[w] += n
                if len(total) >= HELD_WORDS:
                    yield pd.DataFrame({"word": list(total), "n": list(total.values())})
                    total = Counter()
        if total:
            yield pd.DataFrame({"word": list(total), "n": list(total.values())})
    return run


def count_words(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", min_letters: int = MIN_LETTERS,
                min_count: int = MIN_COUNT, change: Callable | None = None) -> DataFrame:
    """word, n: the runs of letters of whole texts, A-Z lower-cased, of at least
    ``min_letters`` letters and ``min_count`` occurrences over all documents.

    ``change`` may replace a document's words before they are counted: it takes
    the document's id (as text) and its words with their counts, and returns
    pairs of the same kind.
    """
    require(docs, id_column, text_column)
    ship(docs.sparkSession)
    parts = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text")).mapInPandas(
        _counter(min_letters, change), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _split(rows: DataFrame) -> DataFrame:
    """Each row twice: with either chunk of its open part added to the key and the other left open."""
    long = F.col("longer").cast("int")
    size = F.length("open") - long  # letters of the shorter word's open part
    half = F.floor(size / 2).cast("int")
    front = F.struct(F.xxhash64("key", F.lit(0), size, F.left("open", half)).alias("key"),
                     F.expr("substring(open, int(floor((length(open) - int(longer)) / 2)) + 1)").alias("open"))
    rest = size - half
    back = F.struct(F.xxhash64("key", F.lit(1), size, F.right("open", rest)).alias("key"),
                    F.left(F.col("open"), F.length("open") - rest).alias("open"))
    return (rows.withColumn("cut", F.explode(F.array(front, back)))
            .select("word", "n", "longer", "cut.key", "cut.open"))


def _meet(rows: DataFrame) -> DataFrame:
    """a, b: words of one group whose open parts are one edit apart."""
    a, b = rows.where(~F.col("longer")).alias("a"), rows.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key"))
                 & (F.col("b.longer") | (F.col("a.word") < F.col("b.word")))
                 & (F.levenshtein(F.col("a.open"), F.col("b.open"), 1) == 1))
    return met.select(F.col("a.word").alias("a"), F.col("a.n").alias("n_a"), F.col("b.word").alias("b"), F.col("b.n").alias("n_b"))


def near_pairs(words: DataFrame, *, levels: int = LEVELS, group_pairs: int = GROUP_PAIRS) -> DataFrame:
    """a, n_a, b, n_b: each pair of ``words`` (word, n; word unique, at least two
    letters) that differ by exactly one inserted, deleted or replaced letter, once."""
    rows = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("longer"),
                        F.lit(0).cast("long").alias("key"), F.col("word").alias("open"))
    open_letters = F.length("open") - F.col("longer").cast("int")
    for _ in range(levels):
        rows = _split(rows.where(open_letters > 1)).unionByName(rows.where(open_letters <= 1))
    found = []
    while True:
        rows = stage(rows, "spelling-keys")
        sizes = rows.where(open_letters > 1).groupBy("key").agg(
            F.count_if(~F.col("longer")).alias("short"), F.count_if(F.col("longer")).alias("long"))
        hot = stage(sizes.where(F.col("short") * (F.col("short") + F.col("long")) > group_pairs).select("key"), "spelling-hot")
        if hot.isEmpty():
            found.append(_meet(rows))
            break
        found.append(_meet(rows.join(hot, "key", "left_anti")))
        crowded = rows.join(hot, "key", "left_semi")
        # a row of one letter that shares a crowded key meets nothing there but its own kind
        rows = _split(crowded.where(open_letters > 1)).unionByName(crowded.where(open_letters <= 1))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct().where(F.levenshtein(F.col("a"), F.col("b"), 1) == 1)


def group_variants(words: DataFrame, *, ratio: int = RATIO, levels: int = LEVELS, group_pairs: int = GROUP_PAIRS) -> DataFrame:
    """word, n, n_near (near words), form, form_n (the near word of largest n, ties by
    smallest in code-point order, if it has at least ``ratio`` times as many
    occurrences; else null) and root (the last form that forms lead to, or the
    word itself) of each of ``words`` (word, n)."""
    require(words, "word", "n")
    if ratio < 2:
        raise ValueError("forms lead to a root only if each is commoner than the last")
    words = stage(words.select("word", "n"), "spelling-words")
    pairs = near_pairs(words, levels=levels, group_pairs=group_pairs)
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form")).alias("other")),
        F.struct(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("less"), F.col("a").alias("form")).alias("other")))
    ).alias("side")).select("side.*")
    best = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("other").alias("other"))
    known = words.join(best, "word", "left")
    formed = F.coalesce(-F.col("other.less") >= ratio * F.col("n"), F.lit(False))
    formed = known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                          F.when(formed, F.col("other.form")).alias("form"),
                          F.when(formed, -F.col("other.less")).alias("form_n"))
    formed = stage(formed, "spelling-forms")
    # Each round doubles the forms that a step covers; each form is ``ratio`` times commoner than
    # the one before, so 64-bit counts allow few.
    steps = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(steps.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return formed.join(steps, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def variants(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", min_letters: int = MIN_LETTERS,
             min_count: int = MIN_COUNT, ratio: int = RATIO, change: Callable | None = None) -> DataFrame:
    """:func:`group_variants` of the words of whole texts.

    Null and empty texts have no words; ids are used by ``change`` alone, so null
    and repeated ones are no matter; every row counts, repeated ones as often as
    they stand; other columns are not looked at; an empty table gives no rows.
    ``min_letters`` is 2 at least.
    """
    if min_letters < 2:
        raise ValueError("words of one letter have no two chunks")
    return group_variants(count_words(docs, id_column=id_column, text_column=text_column, min_letters=min_letters,
                                      min_count=min_count, change=change), ratio=ratio)


def drop_letters(doc: str | None, words: dict[str, int]) -> list[tuple[str, int]]:
    """A ``change`` that misspells: where the unsigned crc32 of ``<id>:<word>`` is
    a multiple of 31, the letter at that number modulo the word's length goes."""
    begin, out = zlib.crc32(f"{doc}:".encode()), []
    for w, n in words.items():
        h = zlib.crc32(w.encode("utf-8"), begin)
        if h % 31 == 0:
            k = h % len(w)
            w = w[:k] + w[k + 1:]
        out.append((w, n))
    return out
