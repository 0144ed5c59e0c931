"""Token-id output: tokenised texts in a compressed binary table.

Format, two Parquet tables under one folder:

``codebook``: id, length. The canonical Huffman code of the corpus, from the
counts of all its ids; at most 16 bits long, or as long as so many ids need.

``blocks``: shard, first (number of the block's first document in its shard),
tokens, doc_ids, lengths (ids of each document), bits, marks. Documents stand
in ascending doc_id over (shard, first). A block can be decoded without any
other; marks are the bit offsets of every 64th id.

Documents are dealt to shards by ranges of doc_id before they are tokenised, so
the text moves once; ids are stored between counting and encoding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.llm.common import require, ship, stage
from stratus.llm.huffman import Code, code_lengths
from stratus.llm.text_ids import binary_column, read_spec, token_ids, with_end

END_ID = 0
BLOCK_TOKENS = 65_536
#: Texts of an Arrow batch that are tokenised at once.
TEXTS = 1000

def _tokenise(spec, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard, seq = token_ids(spec.value), TaskContext.get().partitionId(), 0
        for batch in (whole.slice(i, TEXTS) for whole in batches for i in range(0, whole.num_rows, TEXTS)):
            n = batch.num_rows
            ids, offsets = with_end(*own.encode(batch.column("text")), end_id)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(seq, seq + n)), batch.column("doc_id"),
                 batch.column("no_id"), binary_column(ids, offsets)], ["shard", "seq", "doc_id", "no_id", "ids"])
            seq += n
    return run


def _count(dtype: np.dtype, size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, dtype=np.int64)
        for pdf in batches:
            for i in range(0, len(pdf), 1000):
                total += np.bincount(np.frombuffer(b"".join(pdf["ids"].iloc[i:i + 1000]), dtype=dtype), minlength=size)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"id": used, "n": total[used]})
    return run


def _encode(dtype: np.dtype, lengths: np.ndarray, block_tokens: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code, held, size, shard = Code(lengths), [], 0, None

        def block():
            bits, marks = code.encode(np.frombuffer(b"".join(r[2] for r in held), dtype=dtype))
            sizes = [len(r[2]) // dtype.itemsize for r in held]
            return pd.DataFrame({"shard": [shard], "first": [held[0][0]], "tokens": [sum(sizes)],
                                 "doc_ids": [[r[1] for r in held]], "lengths": [sizes],
                                 "bits": [bits], "marks": [marks]})
        for pdf in batches:
            for part, seq, doc_id, no_id, ids in zip(*(pdf[c] for c in ("shard", "seq", "doc_id", "no_id", "ids"))):
                if held and (part != shard or size >= block_tokens or seq != held[-1][0] + 1):
                    yield block()
                    held, size = [], 0
                shard = part
                held.append((seq, None if no_id else doc_id, ids))
                size += len(ids) // dtype.itemsize
        if held:
            yield block()
    return run


def write(docs: DataFrame, path: str, tokenizer_path: str, *, id_column: str = "doc_id",
          text_column: str = "text", end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> None:
    """Tokenise ``docs`` and write them under ``path`` in ascending doc_id.

    Null and empty texts have the end id alone. Rows that repeat an id stand
    side by side, ordered by a hash of the text; null ids stand first.
    """
    require(docs, id_column, text_column)
    spark = docs.sparkSession
    spec = read_spec(tokenizer_path)
    kind = token_ids(spec)
    dtype, vocabulary = kind.dtype, kind.vocabulary
    key = F.col(id_column).cast("long")
    rows = docs.select(key.isNull().alias("no_id"), F.coalesce(key, F.lit(0)).alias("doc_id"), F.col(text_column).alias("text"))
    order = [F.desc("no_id"), "doc_id", F.xxhash64("text"), "text"]
    dealt = rows.repartitionByRange(*order[:3]).sortWithinPartitions(*order)
    ids = stage(dealt.mapInArrow(_tokenise(spark.sparkContext.broadcast(spec), end_id),
                                  "shard int, seq long, doc_id long, no_id boolean, ids binary"), "token-ids")
    counts = (ids.select("ids").mapInPandas(_count(dtype, max(vocabulary, end_id + 1)), "id int, n long")
              .groupBy("id").agg(F.sum("n").alias("n")).collect())  # at most one row per id of the vocabulary
    total = np.zeros(max(vocabulary, end_id + 1), dtype=np.int64)
    for r in counts:
        total[r["id"]] = r["n"]
    lengths = code_lengths(total)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id int, length int"
                          ).coalesce(1).write.parquet(f"{path}/codebook")
    ids.mapInPandas(_encode(dtype, lengths, block_tokens),
                    "shard int, first long, tokens long, doc_ids array<long>, lengths array<int>, bits binary, "
                    "marks binary").write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def _decode(lengths: np.ndarray, with_ids: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = Code(lengths)
        for pdf in batches:
            for i in range(0, len(pdf), 8):  # a few blocks at once: more lanes, bounded memory
                part = pdf.iloc[i:i + 8]
                ids = code.decode(list(zip(part["bits"], part["marks"], part["tokens"]))).astype("<u4")
                sizes = np.concatenate([np.asarray(x) for x in part["lengths"]])
                end = np.cumsum(sizes)
                raw = memoryview(ids.tobytes())
                texts = [raw[4 * (e - n):4 * e] for e, n in zip(end, sizes)]
                within = np.concatenate([np.cumsum(x) - np.asarray(x) for x in part["lengths"]])
                repeat = part["lengths"].map(len)
                out = pd.DataFrame({
                    "shard": np.repeat(part["shard"].to_numpy(), repeat), "first": np.repeat(part["first"].to_numpy(), repeat),
                    "doc_id": pd.array([d for x in part["doc_ids"] for d in x], dtype="Int64"), "within": within,
                    "n_tokens": sizes, "ids_crc32": [zlib.crc32(t) for t in texts]})
                if with_ids:
                    out["ids"] = [np.frombuffer(t, dtype="<u4") for t in texts]
                yield out
    return run


def read(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 (of the ids as little-endian uint32) and, if asked for, ids."""
    book = ship(spark).read.parquet(f"{path}/codebook").collect()  # the vocabulary at most
    lengths = np.zeros(max([r["id"] for r in book], default=0) + 1, dtype=np.uint8)
    for r in book:
        lengths[r["id"]] = r["length"]
    blocks = spark.read.parquet(f"{path}/blocks")
    docs = blocks.mapInPandas(
        _decode(lengths, with_ids), "shard int, first long, doc_id long, within long, n_tokens long, ids_crc32 long"
        + (", ids array<long>" if with_ids else ""))
    # Where each block starts: within its shard, and the shard among the shards (one row each).
    index = blocks.select("shard", "first", "tokens")
    before = Window.partitionBy("shard").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    shards = index.groupBy("shard").agg(F.sum("tokens").alias("tokens")).select(
        "shard", F.coalesce(F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)).alias("base"))
    index = index.withColumn("offset", F.coalesce(F.sum("tokens").over(before), F.lit(0))).join(shards, "shard")
    found = docs.join(index.drop("tokens"), ["shard", "first"])
    return found.select("doc_id", (F.col("base") + F.col("offset") + F.col("within")).alias("start"),
                        "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
