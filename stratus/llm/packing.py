"""Packing of tokenised documents into sequences of one length.

Texts are tokenised, closed by an end id and, if longer than a sequence, cut into
pieces of that length (the first takes what is over). Full pieces are sequences
of their own. The others are dealt to groups of about ``GROUP_ITEMS``; each is
packed best fit, longest first, and then improved by local search: while some
underfull sequence can gain tokens from a less filled one, by moving a piece,
exchanging one for one, two for one or one for two, the exchange that fills it
most is made. Each exchange raises the sum of squared fills, so the search
ends; sequences that lose their last piece are gone. What is still underfull is
dealt anew, by sequences, to as many groups as its pieces need, and the search
goes on across the old groups, until it has been in one group or a round saves
no sequence. No group holds more than its share, whatever the sizes are.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.llm.common import require, ship, stage
from stratus.llm.text_ids import read_spec, token_ids, with_end

LENGTH, END_ID = 1024, 2
GROUP_ITEMS = 8192


class Packer:
    """Sequences (lists of piece numbers) of pieces of given sizes, at most ``length`` tokens each."""

    def __init__(self, sizes: list[int], length: int):
        self.sizes, self.length = sizes, length
        self.bins: list[list[int]] = []
        self.fill: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the fullest sequence that takes it."""
        gaps: list[list[int]] = [[] for _ in range(self.length + 1)]
        open_ = 0  # bit g: some sequence has a gap of g
        for i in sorted(range(len(self.sizes)), key=lambda i: -self.sizes[i]):
            size = self.sizes[i]
            fits = open_ >> size
            if fits:
                gap = size + (fits & -fits).bit_length() - 1
                b = gaps[gap].pop()
                if not gaps[gap]:
                    open_ ^= 1 << gap
                self.bins[b].append(i)
                self.fill[b] += size
            else:
                b, gap = len(self.bins), self.length
                self.bins.append([i])
                self.fill.append(size)
            if gap > size:
                gaps[gap - size].append(b)
                open_ |= 1 << (gap - size)

    def search(self) -> int:
        """Exchange until none raises the sum of squared fills; returns how many were made."""
        made = 0
        while True:
            before = made
            waiting = [(-fill, b) for b, fill in enumerate(self.fill) if 0 < fill < self.length]
            heapq.heapify(waiting)
            self.one, self.two = _Index(self.length), _Index(self.length)
            for _, b in waiting:
                self._offer(b, True)
            while waiting:
                fill, a = heapq.heappop(waiting)
                if -fill != self.fill[a] or not fill:
                    continue  # it has given since; another entry tells its fill
                self._offer(a, False)  # from now on it only receives, from less filled ones
                while self.fill[a] < self.length and (found := self._best(a)):
                    b = self._exchange(a, *found)
                    heapq.heappush(waiting, (-self.fill[b], b))
                    made += 1
            if made == before:
                return made

    def _offer(self, b: int, there: bool) -> None:
        """Put the pieces of b and the sums of two of them into the index, or take them out."""
        own = sorted({self.sizes[i] for i in self.bins[b]})
        twice = {s for s in own if sum(self.sizes[i] == s for i in self.bins[b]) > 1}
        for k, s in enumerate(own):
            self.one.set(s, b, there)
            for t in own[k:]:
                if t > s or s in twice:
                    self.two.set(s + t, b, there)

    def _best(self, a: int) -> tuple[int, int, int, int] | None:
        """(gain, tokens given, tokens taken, pieces taken) of the exchange that fills a most."""
        gap, best = self.length - self.fill[a], None
        own = sorted({self.sizes[i] for i in self.bins[a]})
        given = [0, *own]
        for g in given:
            for taken, index in ((1, self.one), (2, self.two)):
                if taken == 2 and not g:
                    continue  # two moves
                size = index.largest(g, g + gap)
                if size and (best is None or size - g > best[0]):
                    best = (size - g, g, size, taken)
                    if best[0] == gap:
                        return best
        for k, s in enumerate(own):  # two for one
            for t in own[k:]:
                if s == t and sum(self.sizes[i] == s for i in self.bins[a]) < 2:
                    continue
                size = self.one.largest(s + t, s + t + gap)
                if size and (best is None or size - s - t > best[0]):
                    best = (size - s - t, -(s * (self.length + 1) + t), size, 1)
                    if best[0] == gap:
                        return best
        return best

    def _pick(self, b: int, sizes: list[int]) -> list[int]:
        out, left = [], list(self.bins[b])
        for s in sizes:
            i = next(i for i in left if self.sizes[i] == s)
            left.remove(i)
            out.append(i)
        return out

    def _exchange(self, a: int, gain: int, given: int, size: int, taken: int) -> int:
        index = self.one if taken == 1 else self.two
        b = min(index.holders[size], key=lambda b: (self.fill[b], b))
        give = [] if not given else [given] if given > 0 else list(divmod(-given, self.length + 1))
        if taken == 1:
            take = [size]
        else:
            own = sorted(self.sizes[i] for i in self.bins[b])
            low, high = 0, len(own) - 1
            while own[low] + own[high] != size:
                low, high = (low + 1, high) if own[low] + own[high] < size else (low, high - 1)
            take = [own[low], own[high]]
        self._offer(b, False)
        out, back = self._pick(b, take), self._pick(a, give)
        self.bins[a] = [i for i in self.bins[a] if i not in back] + out
        self.bins[b] = [i for i in self.bins[b] if i not in out] + back
        self.fill[a] += gain
        self.fill[b] -= gain
        self._offer(b, True)
        return b


class _Index:
    """Sequences by a size that they hold; bits tell which sizes there are."""

    def __init__(self, length: int):
        self.holders: dict[int, set[int]] = {}
        self.there = 0

    def set(self, size: int, b: int, there: bool) -> None:
        held = self.holders.setdefault(size, set())
        if there:
            held.add(b)
            self.there |= 1 << size
        else:
            held.discard(b)
            if not held:
                self.there &= ~(1 << size)

    def largest(self, above: int, upto: int) -> int:
        """The largest size in (above, upto]; 0 if there is none."""
        size = (self.there & ((1 << (upto + 1)) - 1)).bit_length() - 1
        return size if size > above else 0


def _pieces(spec, length: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seen, full = token_ids(spec.value), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            ids, offsets = with_end(*own.encode(batch.column("text")), end_id)
            size = np.diff(offsets)
            n = -(-size // length)
            doc = np.repeat(np.arange(len(size)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            first = (size - 1) % length + 1
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * length)
            long = np.where(piece == 0, first[doc], length)
            begin = offsets[:-1][doc] + start
            raw = memoryview(ids.astype("<u4").tobytes())
            whole = long == length
            sequence = (part << 36) + full + np.cumsum(whole) - 1
            columns = {
                "id": batch.column("id").take(pa.array(doc)), "part": pa.array(np.full(len(doc), part, np.int32)),
                "row": pa.array(seen + doc), "piece": pa.array(piece.astype(np.int32)), "start": pa.array(start),
                "length": pa.array(long), "ids_crc32": pa.array([zlib.crc32(raw[4 * b:4 * (b + k)]) for b, k in zip(begin, long)], pa.int64()),
                "sequence_id": pa.array(sequence, mask=~whole)}
            if with_ids:
                columns["ids"] = pa.array([raw[4 * b:4 * (b + k)].tobytes() for b, k in zip(begin, long)], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)
            seen, full = seen + len(size), full + int(whole.sum())
    return run


def _packed(length: int, turn: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if turn == 1:
            pdf = pdf.sort_values(["length", "part", "row", "piece"], ascending=[False, True, True, True], ignore_index=True)
        else:
            pdf = pdf.sort_values(["sequence_id", "offset"], ignore_index=True)
        packer = Packer(pdf["length"].tolist(), length)
        if turn == 1:
            packer.best_fit()
        else:
            for _, own in pdf.groupby("sequence_id").indices.items():
                packer.bins.append(own.tolist())
                packer.fill.append(int(pdf["length"].to_numpy()[own].sum()))
        packer.search()
        sequence, offset, fill = (np.zeros(len(pdf), np.int64) for _ in range(3))
        base = (turn << 56) + (int(pdf["group"].iloc[0]) << 20) if len(pdf) else 0
        number = 0
        for own, total in zip(packer.bins, packer.fill):
            if not own:
                continue
            sequence[own], fill[own] = base + number, total
            at = 0
            for i in own:
                offset[i] = at
                at += packer.sizes[i]
            number += 1
        return pdf.assign(sequence_id=sequence, offset=offset, fill=fill)
    return run


_STATE = "id string, part int, row long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, fill long"


def _turn(items: DataFrame, groups: int, length: int, turn: int) -> DataFrame:
    """One round: rows (with sequence_id from the second on) dealt to groups and packed there."""
    key = F.xxhash64("part", "row", "piece") if turn == 1 else F.xxhash64("sequence_id", F.lit(turn))
    dealt = items.withColumn("group", F.pmod(key, F.lit(groups)))
    packed = dealt.groupBy("group").applyInPandas(_packed(length, turn), f"{_STATE}, group long")
    return stage(packed.drop("group"), "packing-round")


def pack(docs: DataFrame, tokenizer_path: str, *, id_column: str = "doc_id", text_column: str = "text",
         length: int = LENGTH, end_id: int = END_ID, group_items: int = GROUP_ITEMS, with_ids: bool = False) -> DataFrame:
    """One row per piece: the id column, part and row (the document's number in the
    tokenising run), piece (from 0), start (its document's ids before it), length,
    ids_crc32 (of its ids as little-endian uint32), sequence_id, offset (its place
    there) and, if asked for, ids (as such bytes).

    Null and empty texts are the end id alone. Null and repeated ids are kept:
    each row is a document. Other columns are not looked at; an empty table
    gives no rows.
    """
    require(docs, id_column, text_column)
    if length < 1:
        raise ValueError("a sequence holds one token at least")
    spark = ship(docs.sparkSession)
    spec = spark.sparkContext.broadcast(read_spec(tokenizer_path))
    schema = T.StructType.fromDDL("part int, row long, piece int, start long, length long, ids_crc32 long, sequence_id long"
                                  + (", ids binary" if with_ids else ""))
    schema = T.StructType([T.StructField("id", T.StringType()), *schema.fields])
    pieces = stage(docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text"))
                   .mapInArrow(_pieces(spec, length, end_id, with_ids), schema), "packing-pieces")
    names = [c.split()[0] for c in _STATE.split(", ")]
    done = [pieces.where(F.col("sequence_id").isNotNull()).withColumns(
        {"offset": F.lit(0).cast("long"), "fill": F.col("length")}).select(names)]
    items, turn = pieces.where(F.col("sequence_id").isNull()), 0
    items = items.withColumns({"offset": F.lit(0).cast("long"), "fill": F.col("length")}).select(names)
    left, before = items.count(), None
    while left:
        turn += 1
        groups = -(-left // group_items)
        packed = _turn(items, groups, length, turn)
        first = packed.where(F.col("offset") == 0).agg(
            F.count(F.lit(1)).alias("sequences"), F.count_if(F.col("fill") < length).alias("underfull")).first()
        items = packed.where(F.col("fill") < length)
        done.append(packed.where(F.col("fill") >= length))
        saved = before is None or before > first["sequences"]
        before = first["underfull"]
        if groups == 1 or not saved:
            break
        left = items.count()
    done.append(items)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    out = out.drop("fill")
    if with_ids:
        out = out.join(pieces.select("part", "row", "piece", "ids"), ["part", "row", "piece"])
    return out.withColumn("id", F.col("id").cast(docs.schema[id_column].dataType)).withColumnRenamed("id", id_column)


def sequences(packed: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The packed sequences themselves, from :func:`pack` with ids: sequence_id, length,
    ids (little-endian uint32) and pieces (id, piece, offset, length, by offset)."""
    own = F.struct("offset", "length", F.col(id_column).alias("id"), "piece", "ids")
    held = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(own)).alias("held"))  # at most ``length`` pieces
    return held.select(
        "sequence_id", F.aggregate("held", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("length"),
        F.aggregate("held", F.lit(b""), lambda b, x: F.concat(b, x["ids"])).alias("ids"),
        F.transform("held", lambda x: F.struct(x["id"].alias("id"), x["piece"].alias("piece"), x["offset"].alias("offset"),
                                               x["length"].alias("length"))).alias("pieces"))
