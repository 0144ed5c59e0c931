"""Incremental recompute of the month-scoped feature table.

Because every feature is scoped to a calendar month, a batch of new readings
only changes the months it touches. Those months are recomputed from the
readings source (semi-join on the touched months) and written with dynamic
partition overwrite, so the other months' files are left as they are. A store
fed batch by batch is laid out by month first, so a batch opens the
directories of the months it touches and no others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratus import sinks
from stratus.operators.clean import clean_readings
from stratus.operators.daily import daily_agg, date_of
from stratus.operators.features import daily_features
from stratus.profile import READINGS, Profile

PARTITION_COLUMNS = ("year", "month")
# Layout of a readings store fed batch by batch (see ``store_batch``).
STORE_PARTITIONS = ("reading_year", "reading_month", "batch_id")


def feature_table(readings: DataFrame, profile: Profile = READINGS,
                  series_keys: tuple[str, ...] = ()) -> DataFrame:
    daily = daily_agg(clean_readings(readings, profile), profile, series_keys=series_keys)
    return daily_features(daily, series_keys=series_keys)


def write_feature_table(readings: DataFrame, path: str, profile: Profile = READINGS,
                        dynamic: bool = False, series_keys: tuple[str, ...] = ()) -> sinks.WriteResult:
    return sinks.write_parquet(feature_table(readings, profile, series_keys), path,
                               partition_by=list(PARTITION_COLUMNS), dynamic_partitions=dynamic)


def touched_months(batch: DataFrame, profile: Profile = READINGS) -> DataFrame:
    day = date_of(batch, profile.date_column)
    return (batch.select(F.year(day).alias("year"), F.month(day).alias("month"))
            .where(F.col("year").isNotNull()).distinct())


def apply_batch(source: DataFrame, batch: DataFrame, path: str,
                profile: Profile = READINGS) -> sinks.WriteResult:
    """Recompute the months ``batch`` touches from ``source`` (which already
    contains the batch) and overwrite only those partitions at ``path``."""
    day = date_of(source, profile.date_column)
    keyed = source.withColumns({"_y": F.year(day), "_m": F.month(day)})
    months = touched_months(batch, profile).withColumnsRenamed({"year": "_y", "month": "_m"})
    affected = keyed.join(months, ["_y", "_m"], "left_semi").drop("_y", "_m")
    return write_feature_table(affected, path, profile, dynamic=True)


def incremental_run(spark: SparkSession, readings: DataFrame, cutoff: str, path: str,
                    profile: Profile = READINGS) -> DataFrame:
    """Process readings before ``cutoff`` as a first load, then the rest as a
    new batch; return the resulting table (equal to a full recompute)."""
    ts = F.col(profile.date_column)
    bound = F.lit(cutoff).cast(readings.schema[profile.date_column].dataType)
    is_new = F.coalesce(ts >= bound, F.lit(False))
    write_feature_table(readings.where(~is_new), path, profile)
    apply_batch(readings, readings.where(is_new), path, profile)
    return spark.read.parquet(path)


@dataclass(frozen=True)
class StoredBatch:
    """What ``store_batch`` wrote: its row count and the (year, month) pairs
    it touched (a set bounded by the calendar the batch spans)."""

    rows: int
    months: tuple[tuple[int, int], ...]


def store_batch(batch: DataFrame, store_path: str, batch_id: int,
                profile: Profile = READINGS) -> StoredBatch:
    """Add a batch of readings to a store laid out by reading month, then batch.

    Only the batch's own directories are written (dynamic partition overwrite),
    so a batch replayed after a failure rewrites exactly those. The rebalance
    hint clusters each month's rows into few files, and AQE splits a month that
    holds a large share of the batch over several tasks. The row count and the
    touched months are observed on the write itself (its result stage); the
    months are as many as the directories that the write commits.
    """
    day = date_of(batch, profile.date_column)
    keyed = (batch.withColumns({"reading_year": F.year(day), "reading_month": F.month(day),
                                "batch_id": F.lit(int(batch_id))})
             .hint("rebalance", "reading_year", "reading_month"))
    stored = Observation(f"store-{batch_id}")
    month = F.when(F.col("reading_year").isNotNull(),
                   F.struct(F.col("reading_year").alias("y"), F.col("reading_month").alias("m")))
    (keyed.observe(stored, F.count(F.lit(1)).alias("rows"), F.collect_set(month).alias("months"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*STORE_PARTITIONS).parquet(store_path.rstrip("/")))
    got = stored.get
    months = tuple(sorted((int(r["y"]), int(r["m"])) for r in (got["months"] or [])))
    return StoredBatch(int(got["rows"]), months)


def merge_batches(spark: SparkSession, store_path: str, before_batch: int, target_bytes: int = sinks.compaction.TARGET_FILE_BYTES) -> DataFrame:
    """Merge the small files that batches before ``before_batch`` have left, month by
    month, into the directory ``batch_id=-1``. Those batches are done; later ones,
    which may be replayed, keep their directories."""
    def into(directory: str) -> str | None:
        month, _, batch = directory.rpartition("/batch_id=")
        return f"{month}/batch_id=-1" if int(batch) < before_batch else None
    return sinks.compact_files(spark, store_path, target_bytes, target_bytes, into)


def stored_months(spark: SparkSession, store_path: str, schema,
                  months: tuple[tuple[int, int], ...]) -> DataFrame:
    """The stored readings of the given months, opening their directories only."""
    root = store_path.rstrip("/")
    paths = [f"{root}/reading_year={y}/reading_month={m}" for y, m in months]
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def apply_stored_batch(spark: SparkSession, store_path: str, schema, path: str,
                       touched: tuple[tuple[int, int], ...],
                       profile: Profile = READINGS) -> sinks.WriteResult | None:
    """Recompute the months a stored batch touched (``StoredBatch.months``) from
    those months of the store (readings of ``schema``), and overwrite them at ``path``."""
    if not touched:
        return None
    return write_feature_table(stored_months(spark, store_path, schema, touched), path, profile, dynamic=True)
