"""Records of split text files whose quoted fields hold line breaks.

A line break belongs to a record when an odd number of quotes stands before it.
Whether that is so at the start of a piece of a file depends on every piece
before it, but only on the parity of their quotes: one small row per piece. So
files stay splittable: pieces are counted, the counts of a file's pieces are
added up in order, and each piece then knows whether it starts inside quotes.
Pieces without a line that opens or closes a quote go through as they are. The
lines of the others are joined where they are read, in the order they stand in;
only the records that reach over the end of a piece are brought together, which
is at most two fragments a piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus import sinks
from stratus.session import shared_dir

#: A record longer than this many characters is undone: its lines are read singly.
MAX_RECORD_CHARS = 1_000_000

_SETTLED = "line string, _nth long, _head boolean, _chars long, _quotes long"


def _joiner(max_chars: int):
    """Lines (line, odd, chars, nth and inside of their piece; a piece's lines in order) ->
    settled lines, with _head null, and fragments: the part of a record that begins before
    the piece (_head) and of one that goes on after it. A fragment of more than
    ``max_chars`` leaves its lines singly, and a row without a line in its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, is_open, head = None, False, False  # the piece, whether a record is open, and begun before the piece
        held, size, over = [], 0, False  # lines of the open record, their characters, whether they are too many

        def rows(lines, head=None, chars=0, quotes=0):
            n = len(lines)
            return pa.RecordBatch.from_arrays([
                lines.cast(pa.string()), pa.array(np.full(n, piece)), pa.array([head] * n if head is not None else pa.nulls(n), pa.bool_()),
                pa.array(np.full(n, chars)), pa.array(np.full(n, quotes))], ["line", "_nth", "_head", "_chars", "_quotes"])

        def joined(lines, ends):
            """One line of every stretch of lines that ends before one of ``ends``."""
            stretches = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), lines)
            return pc.binary_join(stretches, pa.scalar("\n", lines.type))

        def fragment(closed):
            quotes = int(closed) if head else 1
            if over:
                return rows(pa.nulls(1, pa.string()), head, size, quotes)
            lines = pa.concat_arrays(held)
            return rows(joined(lines, [len(lines)]), head, size, quotes)

        def hold(lines, chars):
            """Keep lines of the open record; once they are too many, they are given back."""
            nonlocal held, size, over
            size += chars
            if over:
                return lines
            held.append(lines)
            if size <= max_chars:
                return None
            lines, held, over = pa.concat_arrays(held), [], True
            return lines

        for batch in batches:
            nths, insides = batch.column("nth").to_numpy(), batch.column("inside").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(nths)) + 1, [len(nths)]])
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if low == high:
                    continue
                if nths[low] != piece:
                    if size:
                        yield fragment(False)
                    piece, is_open = int(nths[low]), bool(insides[low])
                    head, held, size, over = is_open, [], 0, False
                lines = batch.column("line").slice(low, high - low)
                odd = batch.column("odd").to_numpy()[low:high]
                chars = batch.column("chars").to_numpy()[low:high] + 1
                after = (np.cumsum(odd) + is_open) % 2
                ends = np.flatnonzero(after == 0) + 1
                at = 0
                if is_open:
                    at = int(ends[0]) if len(ends) else len(lines)
                    single = hold(lines.slice(0, at), int(chars[:at].sum()))
                    if single is not None:
                        yield rows(single)
                    if not len(ends):
                        continue
                    if head:
                        yield fragment(True)
                    elif not over:
                        whole = pa.concat_arrays(held)
                        yield rows(joined(whole, [len(whole)]))
                    ends = ends[1:]
                    head, held, size, over = False, [], 0, False
                last = int(ends[-1]) if len(ends) else at
                if last > at:
                    starts = np.append(at, ends[:-1])
                    long = np.add.reduceat(chars[:last], starts) > max_chars
                    if long.any():  # the lines of such a record stay single
                        single = np.repeat(long, ends - starts)
                        ends = np.union1d(ends, np.flatnonzero(single) + at + 1)
                    yield rows(joined(lines.slice(at, last - at), ends - at))
                is_open = last < len(lines)
                if is_open:
                    single = hold(lines.slice(last), int(chars[last:].sum()))
                    if single is not None:
                        yield rows(single)
        if size:
            yield fragment(False)
    return run


def whole_lines(spark: SparkSession, path: str, max_record_chars: int = MAX_RECORD_CHARS) -> DataFrame:
    """line, _file: the lines of text files, those of one record joined by a line feed.

    A quote that is never closed, or a record longer than ``max_record_chars``
    (as a stray quote makes one up to the next quoted field), is undone: each of
    its lines comes back as it was. So every line is in exactly one row. A
    line's own end (CR, LF or both) inside a record becomes LF. Files with no
    lines give no rows.
    """
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    text = spark.read.text(path).select(
        F.regexp_replace("value", "\\r$", "").alias("line"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_piece"))
    # One row per piece. A piece that starts inside quotes and closes none belongs whole to a record begun before.
    counted = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_piece")).groupBy("_file", "_piece").agg(F.sum(quotes % 2).alias("_odds"))
    before = Window.partitionBy("_file").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    inside = counted.withColumn("_inside", F.coalesce(F.sum("_odds").over(before), F.lit(0)) % 2)
    begins = F.when((F.col("_inside") == 0) | (F.col("_odds") > 1), F.col("_piece"))
    pieces = inside.withColumn("_from", F.last(begins, ignorenulls=True).over(before)).withColumn("_nth", F.monotonically_increasing_id())
    pieces = sinks.read_back(spark, sinks.write_parquet(pieces, shared_dir(spark, "text-pieces"), verify=False))
    busy = (F.col("_inside") == 1) | (F.col("_odds") > 0)
    # The small side is broadcast, so the lines of a piece stay in order.
    calm = text.join(F.broadcast(pieces.where(~busy)), ["_file", "_piece"]).select("line", "_file")
    lines = text.join(F.broadcast(pieces.where(busy)), ["_file", "_piece"]).select(
        "line", (quotes % 2).cast("long").alias("odd"), F.length("line").cast("long").alias("chars"),
        F.col("_nth").alias("nth"), F.col("_inside").cast("long").alias("inside"))
    # Callers read the lines more than once; only those of the busy pieces are kept as a table.
    settled = sinks.write_parquet(lines.mapInArrow(_joiner(max_record_chars), _SETTLED), shared_dir(spark, "text-records"),
                                  verify=False, metrics={"fragments": F.count("_head")})
    found = sinks.read_back(spark, settled).join(F.broadcast(pieces), "_nth")
    whole = calm.unionByName(found.where("_head is null").select("line", "_file"))
    if not settled.metrics["fragments"]:
        return whole
    # A record is named by the piece it begins in; no piece has more than one that is still open at its end.
    parts = found.where("_head is not null").select(
        "line", "_file", "_piece", "_chars", "_quotes", F.when(F.col("_head"), F.col("_from")).otherwise(F.col("_piece")).alias("_owner"))
    key = ["_file", "_owner"]
    sizes = parts.groupBy(*key).agg(((F.sum("_chars") <= max_record_chars) & (F.sum("_quotes") == 2)).alias("_fits"))
    sized = parts.join(sizes, key)
    joined = sized.where("_fits").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_piece", "line"))).alias("p")).select(
        F.array_join(F.transform("p", lambda x: x["line"]), "\n").alias("line"), "_file")
    undone = sized.where("not _fits and line is not null").select(F.explode(F.split("line", "\n")).alias("line"), "_file")
    over = sinks.write_parquet(joined.unionByName(undone), shared_dir(spark, "text-fragments"), verify=False)
    return whole.unionByName(sinks.read_back(spark, over))
