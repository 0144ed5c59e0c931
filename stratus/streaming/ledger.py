"""A persisted event-time bound for micro-batches.

Each micro-batch leaves one row: how many rows it had, how many were late, and
the latest event time it saw. The bound of a micro-batch is the latest time of
all earlier ones less the allowed delay; it depends on nothing else, so a
micro-batch that is run again is held against the same bound.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.sinks import paths

ROW = "batch_id int, n_rows long, n_late long, last_time timestamp_ntz"


class Ledger:
    def __init__(self, spark: SparkSession, path: str, delay: dt.timedelta):
        self.spark, self.path, self.delay = spark, path.rstrip("/"), delay

    def rows(self) -> DataFrame:
        """batch_id, n_rows, n_late, last_time: one row per micro-batch."""
        if not paths.exists(self.spark, self.path):
            return self.spark.createDataFrame([], ROW)
        return self.spark.read.schema(ROW).parquet(self.path)

    def last_time(self, before: int | None = None) -> dt.datetime | None:
        """The latest event time of the micro-batches before this one (or of all)."""
        rows = self.rows()
        if before is not None:
            rows = rows.where(F.col("batch_id") < before)
        return rows.agg(F.max("last_time")).first()[0]

    def bound(self, before: int | None = None) -> dt.datetime | None:
        last = self.last_time(before)
        return None if last is None else last - self.delay

    def record(self, batch_id: int, n_rows: int, n_late: int, last_time: dt.datetime | None) -> None:
        row = self.spark.createDataFrame([(n_rows, n_late, last_time)], "n_rows long, n_late long, last_time timestamp_ntz")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What micro-batches have left under ``path`` (nothing, before the first)."""
    if not paths.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def event_time(column: str):
    """The column as a time without zone; a text that is none, like null, has no time."""
    return F.try_to_timestamp(F.col(column).cast("string")).cast("timestamp_ntz")
