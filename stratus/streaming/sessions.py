"""Session windows: stretches of a key's events with no pause of ``gap`` or more.

A row is first reduced to its key's bucket of ``gap`` length (events of one
bucket are always in one session), with partial aggregation, so a hot key costs
as many intervals as it has buckets. Intervals are then merged in time order.

On a stream, sessions that may still grow are kept as intervals between
micro-batches, a few columns each, and merged with the next one's. A session is
emitted once the event-time bound (latest time seen less ``delay``) is ``gap``
past its last event. Rows older than the bound of their micro-batch could
belong to a session already emitted; they go to the late table instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from stratus import sinks
from stratus.session import shared_dir
from stratus.streaming.ledger import Ledger, event_time, stored


def _intervals(df: DataFrame, key: str, ts: str, value: str, gap: dt.timedelta) -> DataFrame:
    """key, start, last, n, total: one interval per bucket."""
    width = gap // dt.timedelta(microseconds=1)
    # Any zone will do: only that all rows are cut alike.
    bucket = F.floor(F.unix_micros(F.col("_at").cast("timestamp")) / F.lit(width))
    return (df.withColumn("_at", event_time(ts)).groupBy(key, bucket.alias("_bucket"))
            .agg(F.min("_at").alias("start"), F.max("_at").alias("last"), F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
            .drop("_bucket"))


def _merged(intervals: DataFrame, key: str, gap: dt.timedelta) -> DataFrame:
    """Intervals less than ``gap`` apart become one."""
    before = Window.partitionBy(key).orderBy("start", "last")
    reach = F.max("last").over(before.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col("start") >= reach + F.lit(gap)), 1).otherwise(0)
    numbered = intervals.withColumn("_fresh", fresh).withColumn(
        "_session", F.sum("_fresh").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(key, "_session").agg(
        F.min("start").alias("start"), F.max("last").alias("last"), F.sum("n").alias("n"), F.sum("total").alias("total")).drop("_session")


def session_windows(df: DataFrame, key: str, ts: str, value: str, gap: dt.timedelta) -> DataFrame:
    """key, start, last (event), n, total of every session; rows without a time are left out."""
    timed = df.where(event_time(ts).isNotNull())
    return _merged(_intervals(timed, key, ts, value, gap), key, gap)


class SessionStream:
    """Sessions of a stream, under ``path``: ledger, open (the last micro-batch's is in
    force), emitted (batch) and late (batch)."""

    def __init__(self, spark: SparkSession, path: str, key: str, ts: str, value: str, gap: dt.timedelta, delay: dt.timedelta):
        self.spark, self.path, self.gap = spark, path.rstrip("/"), gap
        self.key, self.ts, self.value = key, ts, value
        self.ledger = Ledger(spark, f"{self.path}/ledger", delay)

    def _read(self, name: str, key_type: str, batch_id: int | None = None) -> DataFrame:
        path = f"{self.path}/{name}" + (f"/batch_id={batch_id}" if batch_id is not None else "")
        schema = f"`{self.key}` {key_type}, start timestamp_ntz, last timestamp_ntz, n long, total double"
        return stored(self.spark, path, schema).select(self.key, "start", "last", "n", "total")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch; running it again writes the same files."""
        bound = self.ledger.bound(batch_id)
        key_type = batch.schema[self.key].dataType.simpleString()
        timed = batch.withColumn("_time", event_time(self.ts))
        reason = F.when(F.col("_time").isNull(), "no_time")
        if bound is not None:
            reason = reason.when(F.col("_time") < F.lit(bound), "before_bound")
        timed = timed.withColumns({"reason": reason, "bound": F.lit(bound).cast("timestamp_ntz")})
        seen = Observation(f"session-late-{batch_id}")
        (timed.where("reason is not null").drop("_time").observe(seen, F.count(F.lit(1)).alias("n"))
         .write.mode("overwrite").parquet(f"{self.path}/late/batch_id={batch_id}"))
        own = _intervals(timed.where("reason is null"), self.key, self.ts, self.value, self.gap)
        fresh = sinks.write_parquet(own, shared_dir(self.spark, "session-intervals"), verify=False,
                                    metrics={"rows": F.sum("n"), "last": F.max("last")})
        n_late = int(seen.get["n"])
        self.ledger.record(batch_id, int(fresh.metrics["rows"] or 0) + n_late, n_late, fresh.metrics["last"])
        now = self.ledger.bound(batch_id + 1)
        known = self._read("open", key_type, batch_id - 1).unionByName(sinks.read_back(self.spark, fresh))
        sessions = _merged(known, self.key, self.gap)
        over = F.lit(False) if now is None else F.col("last") + F.lit(self.gap) <= F.lit(now)
        # One pass: sessions that are over and those that are not, in folders of their own.
        both = sinks.write_parquet(sessions.withColumn("over", over), shared_dir(self.spark, "session-merged"), verify=False)
        merged = sinks.read_back(self.spark, both)
        for name, part in (("emitted", merged.where("over")), ("open", merged.where("not over"))):
            part.drop("over").write.mode("overwrite").parquet(f"{self.path}/{name}/batch_id={batch_id}")

    def emitted(self, key_type: str) -> DataFrame:
        return self._read("emitted", key_type)

    def open(self, key_type: str) -> DataFrame:
        """Sessions that may still grow, after the last micro-batch."""
        last = self.ledger.rows().agg(F.max("batch_id")).first()[0]
        return self._read("open", key_type, -1 if last is None else last)

    def late(self) -> DataFrame:
        """The rows as they came, with reason ('before_bound' or 'no_time'), bound and batch_id."""
        return self.spark.read.parquet(f"{self.path}/late")
