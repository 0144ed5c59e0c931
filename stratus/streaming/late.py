"""Day windows of a stream, with late rows as a second output.

Every row of a micro-batch goes to exactly one place: its day's partial
aggregate, or, if the day was closed before the micro-batch began, the late
table, with the reason and the bound it missed. A day is closed, and its row
written to the closed table, once the latest event time seen is ``delay`` past
its end. Rows in closed days, open days and the late table add up to the rows
that came in, at any time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratus import sinks
from stratus.streaming.ledger import Ledger, event_time, stored


class LateAwareDays:
    """``ts``, ``key`` and ``value`` name the columns; everything is kept under ``path``:
    ledger, partials (day, batch), closed (batch) and late (batch)."""

    def __init__(self, spark: SparkSession, path: str, delay: dt.timedelta, ts: str = "ts", key: str = "event_type",
                 value: str = "value"):
        self.spark, self.path = spark, path.rstrip("/")
        self.ts, self.key, self.value = ts, key, value
        self.ledger = Ledger(spark, f"{self.path}/ledger", delay)

    def _schema(self, key_type: str, *more: str) -> str:
        return ", ".join([f"`{self.key}` {key_type}", "n long", "total double", "day date", *more])

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch; running it again writes the same files."""
        bound = self.ledger.bound(batch_id)
        end = F.date_add("day", 1).cast("timestamp_ntz")
        timed = batch.withColumn("_at", event_time(self.ts)).withColumn("day", F.to_date("_at"))
        closed = F.lit(False) if bound is None else end <= F.lit(bound)
        reason = F.when(F.col("_at").isNull(), "no_time").when(closed, "closed_day")
        timed = timed.withColumns({"reason": reason, "bound": F.lit(bound).cast("timestamp_ntz")})
        late = timed.where("reason is not null").drop("_at", "day")
        seen = Observation(f"late-{batch_id}")
        (late.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{self.path}/late/batch_id={batch_id}"))
        own = timed.where("reason is null").groupBy("day", self.key).agg(
            F.count(F.lit(1)).alias("n"), F.sum(self.value).alias("total"), F.max("_at").alias("_last"))
        written = sinks.write_parquet(own.withColumn("batch_id", F.lit(int(batch_id))), f"{self.path}/partials",
                                      partition_by=["day", "batch_id"], dynamic_partitions=True,
                                      metrics={"rows": F.sum("n"), "last": F.max("_last")})
        n_late = int(seen.get["n"])
        self.ledger.record(batch_id, int(written.metrics["rows"] or 0) + n_late, n_late, written.metrics["last"])
        self._close(batch, batch_id, bound)

    def _close(self, batch: DataFrame, batch_id: int, bound: dt.datetime | None) -> None:
        now = self.ledger.bound(batch_id + 1)
        if now is None:
            return
        end = F.date_add("day", 1).cast("timestamp_ntz")
        due = end <= F.lit(now)
        if bound is not None:
            due = due & (end > F.lit(bound))
        days = self._partials(batch.schema[self.key].dataType.simpleString()).where(due & (F.col("batch_id") <= batch_id))
        days.groupBy("day", self.key).agg(F.sum("n").alias("n"), F.sum("total").alias("total")).write.mode(
            "overwrite").parquet(f"{self.path}/closed/batch_id={batch_id}")

    def _partials(self, key_type: str) -> DataFrame:
        return stored(self.spark, f"{self.path}/partials", self._schema(key_type, "batch_id int"))

    def closed(self, key_type: str = "string") -> DataFrame:
        """day, key, n, total of the days that are closed."""
        return stored(self.spark, f"{self.path}/closed", self._schema(key_type)).select("day", self.key, "n", "total")

    def open(self, key_type: str = "string") -> DataFrame:
        """The same of days that may still grow."""
        parts, now = self._partials(key_type), self.ledger.bound()
        if now is not None:
            parts = parts.where(F.date_add("day", 1).cast("timestamp_ntz") > F.lit(now))
        return parts.groupBy("day", self.key).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))

    def late(self) -> DataFrame:
        """The rows as they came, with reason ('closed_day' or 'no_time'), bound and batch_id."""
        return self.spark.read.parquet(f"{self.path}/late")
