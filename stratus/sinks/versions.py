"""Tables of whole versions, live only after their check.

A version is written to a folder of its own and checked there: count, checksum
and whatever the caller requires of it. Only then a one-row file naming the
folder is added to ``versions/``; the highest number there is the live one. A
write that fails its check, or dies, leaves a folder that no version names, and
readers keep the version they had. Nothing is ever replaced, so a reader's
plan stays valid while new versions appear, on stores without a rename as well.

Numbers are claimed by making an empty file, which only one of several writers
can; the loser takes the next number.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.sinks import paths
from stratus.sinks.files import VerificationError, WriteResult, read_back, write_parquet

_ROW = "n_rows long, checksum string, folder string, columns string"


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    n_rows: int


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _numbers(self) -> list[int]:
        return sorted(int(name.partition("=")[2]) for name, is_folder, _ in paths.listed(self.spark, f"{self.path}/versions")
                      if is_folder and name.startswith("version="))

    def history(self) -> DataFrame:
        """version, n_rows, checksum, folder, columns (DDL), live: one row per published version."""
        if not self._numbers():
            return self.spark.createDataFrame([], f"version int, {_ROW}, live boolean")
        rows = self.spark.read.schema(f"{_ROW}, version int").parquet(f"{self.path}/versions")
        last = rows.agg(F.max("version").alias("last"))
        return rows.crossJoin(last).select("version", "n_rows", "checksum", "folder", "columns",  # one row on the right
                                           (F.col("version") == F.col("last")).alias("live"))

    def publish(self, df: DataFrame, partition_by: list[str] | None = None,
                require: dict[str, Column] | None = None) -> Version:
        """Write ``df`` as the next version. ``require``: aggregates over the written rows
        that must be true, by name; VerificationError names those that are not."""
        folder = f"data/{uuid.uuid4().hex[:12]}"
        result = write_parquet(df, f"{self.path}/{folder}", partition_by=partition_by, verify=False)
        result.check(self.spark)
        if require:
            self._hold(result, require)
        number = max([0, *self._numbers()]) + 1
        while not paths.claim(self.spark, f"{self.path}/claims/{number}"):
            number += 1
        row = [(result.expected_rows, str(result.expected_checksum), folder, df.schema.simpleString())]
        (self.spark.createDataFrame(row, _ROW).coalesce(1).write.mode("error")
         .parquet(f"{self.path}/versions/version={number}"))
        return Version(number, folder, result.expected_rows)

    def _hold(self, result: WriteResult, require: dict[str, Column]) -> None:
        found = read_back(self.spark, result).agg(*[c.alias(k) for k, c in require.items()]).first()
        failed = sorted(k for k in require if not found[k])
        if failed:
            raise VerificationError(f"{result.path} is not published: {', '.join(failed)}")

    def folder(self, version: int | None = None) -> str:
        """Where the rows of a version (default: the live one) are."""
        numbers = self._numbers()
        if not numbers or version is not None and version not in numbers:
            raise FileNotFoundError(f"{self.path} has no version" + (f" {version}" if version is not None else ""))
        number = numbers[-1] if version is None else version
        row = self.spark.read.schema(_ROW).parquet(f"{self.path}/versions/version={number}").first()
        return f"{self.path}/{row['folder']}"

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.folder(version))

    def expire(self, keep: int = 2) -> list[int]:
        """Remove all but the ``keep`` highest versions, and data that no version names
        (call it while nobody publishes); returns the numbers that went."""
        if keep < 1:
            raise ValueError("the live version stays")
        numbers = self._numbers()
        gone = numbers[:-keep]
        kept = {self.folder(n) for n in numbers[-keep:]}
        for n in gone:
            paths.remove(self.spark, f"{self.path}/versions/version={n}")
        for name, is_folder, _ in paths.listed(self.spark, f"{self.path}/data"):
            if is_folder and f"{self.path}/data/{name}" not in kept:
                paths.remove(self.spark, f"{self.path}/data/{name}")
        return gone
