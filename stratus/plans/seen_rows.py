"""Exact de-duplication across batches.

Every accepted row leaves its 128-bit digest in an index, laid out by a prefix of
the digest, then batch, and sets a few bits in a Bloom filter kept as 64-bit
words. A new batch is probed against the filter first; a row that misses a bit
has never been seen, and only the others (repeats, and the filter's false
positives) are joined with the index, which settles them.

A batch looks at what earlier batches left, never at its own or later entries,
so a batch that is run again gives the same rows and writes the same files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus import sinks
from stratus.session import shared_dir
from stratus.sinks import paths

INDEX = "_d1 long, _d2 long, prefix int, batch_id int"
FILTER = "_word long, _bits long, batch_id int"
#: Digests of a filter word that are compared one by one.
CROWDED = 32


def digest(columns: list[str], salt: int) -> Column:
    """64 bits of a row. Hashing skips nulls, so where they stand is hashed as well."""
    values = [F.col(f"`{c}`") for c in columns]
    nulls = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])
    return F.xxhash64(F.lit(salt), nulls, *values)


@dataclass(frozen=True)
class Accepted:
    """``rows``: the batch's rows that no earlier batch had, each once (a written
    table). ``n_rows`` of the batch, ``n_distinct`` of them, ``n_possible`` that the
    filter let through, ``n_new``."""

    rows: DataFrame
    n_rows: int
    n_distinct: int
    n_possible: int
    n_new: int


class SeenRows:
    """``words``: 64-bit words of the filter, a quarter of the rows expected in all or
    more (with fewer, more rows are looked up; results are the same). It and
    ``prefixes`` are fixed for the life of a store."""

    def __init__(self, spark: SparkSession, path: str, words: int = 1 << 22, bits: int = 4, prefixes: int = 16):
        self.spark, self.path = spark, path.rstrip("/")
        self.words, self.bits, self.prefixes = words, bits, prefixes

    def _marked(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        rows = rows.withColumns({"_d1": digest(columns, 1), "_d2": digest(columns, 2)})
        mask = F.lit(0).cast("long")
        for i in range(self.bits):
            place = F.shiftrightunsigned("_d2", 6 * i).bitwiseAND(F.lit(63)).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
        return rows.withColumns({
            "_word": F.pmod("_d1", F.lit(self.words)), "_mask": mask,
            "prefix": F.pmod(F.shiftright("_d1", 32), F.lit(self.prefixes)).cast("int")})

    def _stored(self, name: str, schema: str, before: int) -> DataFrame | None:
        path = f"{self.path}/{name}"
        if not paths.exists(self.spark, path):
            return None
        return self.spark.read.schema(schema).parquet(path).where(F.col("batch_id") < before)

    def accept(self, batch: DataFrame, batch_id: int) -> Accepted:
        """The new rows of ``batch``; they count as seen for later batches."""
        columns = batch.columns
        copies = batch.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("_copies"))
        rows = self._marked(copies, columns)
        bloom = self._stored("filter", FILTER, batch_id)
        if bloom is None:
            rows = rows.withColumns({"_possible": F.lit(False), "_new": F.lit(True)})
        else:
            merged = bloom.groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
            rows = rows.join(merged, "_word", "left")
            possible = F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
            rows = self._looked_up(rows.withColumn("_possible", possible).drop("_bits"), batch_id)
        # Rows that are not new count, but their values need not be kept.
        probed = sinks.write_parquet(
            rows.select(*[F.when(F.col("_new"), F.col(f"`{c}`")).alias(c) for c in columns],
                        "_d1", "_d2", "_word", "_mask", "prefix", "_possible", "_new", "_copies"),
            shared_dir(self.spark, "seen-probed"), verify=False, metrics={
                "rows": F.sum("_copies"), "possible": F.count_if("_possible"), "new": F.count_if("_new")})
        new = sinks.read_back(self.spark, probed).where("_new")
        own = F.lit(int(batch_id)).alias("batch_id")
        sinks.write_parquet(new.select("_d1", "_d2", "prefix", own), f"{self.path}/digests",
                            partition_by=["prefix", "batch_id"], dynamic_partitions=True, verify=False)
        sinks.write_parquet(new.groupBy("_word").agg(F.bit_or("_mask").alias("_bits")).withColumn("batch_id", own),
                            f"{self.path}/filter", partition_by=["batch_id"], dynamic_partitions=True, rebalance=False, verify=False)
        return Accepted(new.select(*[F.col(f"`{c}`") for c in columns]), int(probed.metrics["rows"] or 0),
                        probed.expected_rows, int(probed.metrics["possible"] or 0), int(probed.metrics["new"] or 0))

    def _looked_up(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """``rows`` with _new: whether no earlier batch left their digest.

        The rows stand by filter word already, so the digests are brought to them by
        word, and those of a word are compared there; with many to a word (the filter
        is too small) they are joined by digest, for which the rows move again.
        """
        index = self._stored("digests", INDEX, batch_id).select("_d1", "_d2")
        by_word = index.count() <= CROWDED * self.words
        index = index.withColumn("_word", F.pmod("_d1", F.lit(self.words)))
        if by_word:
            index = index.repartition("_word")
        index = index.distinct().select(*[F.col(c).alias(f"_i{c}") for c in ("_word", "_d1", "_d2")])
        d1, d2 = (F.col(c) == F.col(f"_i{c}") for c in ("_d1", "_d2"))
        if by_word:  # a condition beside the key, not a key: keys would move the rows
            d1, d2 = (F.col(c).bitwiseXOR(F.col(f"_i{c}")) == 0 for c in ("_d1", "_d2"))
        found = rows.join(index, (F.col("_word") == F.col("_i_word")) & F.col("_possible") & d1 & d2, "left")
        return found.withColumn("_new", F.col("_i_word").isNull()).drop("_i_word", "_i_d1", "_i_d2")
