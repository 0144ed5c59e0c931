"""Streaming daily aggregates over an event source.

``daily_event_stream`` keeps one state row per (day, key) -- bounded by the
calendar times the key domain -- and emits the rows that a micro-batch changed
through ``foreachBatch``, into a folder of that micro-batch, so one replayed
after a failure writes the same files (idempotent sink) and readers never meet
an empty table.
``closed_window_stream`` is the append form: a watermark on event time closes
day windows, late rows beyond it are dropped by design, and only closed
windows are emitted.

Both run with ``trigger(availableNow=True)``: all data present at start is
processed in bounded micro-batches, then the query stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _source(spark: SparkSession, directory: str, pattern: str, schema: T.StructType,
            max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(directory)


def daily_event_stream(spark: SparkSession, directory: str, pattern: str, schema: T.StructType,
                       out_path: str, checkpoint: str, ts_column: str = "ts",
                       key: str = "event_type", value: str = "value",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """date, <key>, n, avg_value per day in update mode: each micro-batch writes the
    days it changed; returns the latest row of every day and key once the stream
    has processed everything available."""
    events = _source(spark, directory, pattern, schema, max_files_per_trigger)
    agg = (events.groupBy(F.to_date(F.col(ts_column)).alias("date"), F.col(key))
           .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(value)).alias("avg_value")))

    def publish(batch: DataFrame, batch_id: int) -> None:
        # Keys that changed; a later micro-batch's row of a key replaces an earlier one's.
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    query = (agg.writeStream.outputMode("update").foreachBatch(publish)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    written = spark.read.parquet(out_path)
    latest = written.groupBy("date", key).agg(F.max_by(F.struct("n", "avg_value"), "batch_id").alias("row"))
    return latest.select("date", key, "row.n", "row.avg_value")


def closed_window_stream(spark: SparkSession, directory: str, pattern: str, schema: T.StructType,
                         out_path: str, checkpoint: str, ts_column: str = "ts",
                         key: str = "event_type", value: str = "value",
                         watermark: str = "1 day",
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Append mode over event-time day windows: window_start, window_end,
    <key>, n, avg_value for windows closed by the watermark."""
    events = _source(spark, directory, pattern, schema, max_files_per_trigger)
    # Watermarks need a zoned timestamp; the session zone is pinned to UTC.
    timed = events.withColumn("_event_time", F.col(ts_column).cast("timestamp"))
    agg = (timed.withWatermark("_event_time", watermark)
           .groupBy(F.window("_event_time", "1 day"), F.col(key))
           .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(value)).alias("avg_value"))
           .select(F.col("window.start").alias("window_start"),
                   F.col("window.end").alias("window_end"), key, "n", "avg_value"))
    query = (agg.writeStream.outputMode("append").format("parquet")
             .option("path", out_path).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(out_path)


def feature_stream(spark: SparkSession, directory: str, pattern: str, schema: T.StructType,
                   store_path: str, features_path: str, checkpoint: str,
                   profile=None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Maintain the month-scoped feature table from a stream of readings.

    Each micro-batch is added to a readings store laid out by reading month
    (dynamic overwrite of its own directories: a replayed batch writes the
    same files); then only the months the batch touches are recomputed, from
    those months' directories alone (no others are listed), and replaced in the
    feature table with dynamic partition overwrite. Rolling and lag windows
    cannot run inside a stream; running them per batch on the touched months
    is exact because every window is scoped to one month.
    """
    from stratus.plans import incremental
    from stratus.profile import READINGS

    prof = profile or READINGS
    readings = _source(spark, directory, pattern, schema, max_files_per_trigger)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        stored = incremental.store_batch(batch, store_path, batch_id, prof)
        if stored.rows:
            incremental.apply_stored_batch(spark, store_path, schema, features_path, stored.months, prof)

    query = (readings.writeStream.foreachBatch(upsert)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(features_path)


def run_batches(spark: SparkSession, directory: str, pattern: str, schema: T.StructType, process, checkpoint: str,
                max_files_per_trigger: int | None = None) -> None:
    """Feed what is in ``directory`` to ``process(batch, batch_id)``, micro-batch by
    micro-batch, until everything available has been processed."""
    query = (_source(spark, directory, pattern, schema, max_files_per_trigger).writeStream.foreachBatch(process)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
