"""Daily aggregates kept as mergeable partial state.

Each batch leaves one small row per day and series: counts, sums, sums of
squared deviations, minima and maxima. They are laid out by month, then batch.
A batch writes its own directories (a batch run again rewrites exactly those)
and the months it touched are merged from their partial rows alone: readings of
earlier batches are never read again. With exact de-duplication across batches
in front, the feature table equals one computed over all readings at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus import sinks
from stratus.functions.exprs import resolve
from stratus.operators.clean import clean_readings
from stratus.operators.daily import date_of
from stratus.operators.features import daily_features
from stratus.plans.incremental import PARTITION_COLUMNS
from stratus.plans.seen_rows import Accepted, SeenRows
from stratus.profile import DAILY_METRICS, READINGS, Profile

STATE_PARTITIONS = (*PARTITION_COLUMNS, "batch_id")


def partial_daily(df: DataFrame, profile: Profile = READINGS, series_keys: tuple[str, ...] = (),
                  zone: str | None = None) -> DataFrame:
    """[series keys], date, n_rows, then for the temperature n, sum, m2 (squared
    deviations from the mean), min and max, and n and sum of each other metric."""
    date_column, temperature = resolve(df, profile.date_column), resolve(df, profile.temperature_column)
    if date_column is None or temperature is None:
        raise ValueError(f"columns {profile.date_column!r} and {profile.temperature_column!r} are needed")
    t = F.col(temperature).cast("double")
    parts = [F.count(F.lit(1)).alias("n_rows"), F.count(t).alias("t_n"), F.sum(t).alias("t_sum"),
             (F.var_pop(t) * F.count(t)).alias("t_m2"), F.min(t).alias("t_min"), F.max(t).alias("t_max")]
    for metric, alias in DAILY_METRICS:
        name = resolve(df, metric)
        if name is not None:
            value = F.col(name).cast("double")
            parts += [F.count(value).alias(f"n_{alias}"), F.sum(value).alias(f"sum_{alias}")]
    return df.groupBy(*series_keys, date_of(df, date_column, zone).alias("date")).agg(*parts)


def merge_partials(parts: DataFrame, series_keys: tuple[str, ...] = ()) -> DataFrame:
    """One partial row per day and series, of any number of them.

    Squared deviations are brought to the common mean (Chan et al.), so nothing
    large is subtracted from something large. The mean is taken over a window
    of the same keys as the group: one exchange.
    """
    keys = [*series_keys, "date"]
    whole = Window.partitionBy(*keys)
    mean = F.sum("t_sum").over(whole) / F.when(F.sum("t_n").over(whole) > 0, F.sum("t_n").over(whole))
    own = F.col("t_sum") / F.when(F.col("t_n") > 0, F.col("t_n"))
    moved = parts.withColumn("t_m2", F.col("t_m2") + F.col("t_n") * (own - mean) * (own - mean))
    others = [c for c in parts.columns if c.startswith(("n_avg_", "sum_avg_"))]
    return moved.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "t_n", "t_sum", "t_m2")], F.min("t_min").alias("t_min"),
        F.max("t_max").alias("t_max"), *[F.sum(c).alias(c) for c in others])


def finish_daily(merged: DataFrame, series_keys: tuple[str, ...] = ()) -> DataFrame:
    """The columns of :func:`stratus.operators.daily.daily_agg` from merged partial rows."""
    n = F.col("t_n")
    out = [*series_keys, "date", "n_rows", F.when(F.col("date").isNull(), 0).otherwise(1).cast("long").alias("unique_days"),
           (F.col("t_sum") / F.when(n > 0, n)).alias("avg_tempC"), F.col("t_max").alias("max_tempC"),
           F.col("t_min").alias("min_tempC"), F.sqrt(F.col("t_m2") / F.when(n > 1, n - 1)).alias("std_tempC")]
    for _, alias in DAILY_METRICS:
        if f"n_{alias}" in merged.columns:
            count = F.col(f"n_{alias}")
            out.append((F.col(f"sum_{alias}") / F.when(count > 0, count)).alias(alias))
    return merged.select(*out)


class DailyState:
    """State and feature table under one folder; see the module's notes."""

    def __init__(self, spark: SparkSession, path: str, profile: Profile = READINGS, series_keys: tuple[str, ...] = (),
                 words: int = 1 << 22):
        self.spark, self.path = spark, path.rstrip("/")
        self.profile, self.series_keys = profile, tuple(series_keys)
        self.seen = SeenRows(spark, f"{self.path}/seen", words=words)

    @property
    def features_path(self) -> str:
        return f"{self.path}/features"

    def add(self, batch: DataFrame, batch_id: int) -> Accepted:
        """Clean ``batch``, drop what earlier batches had, merge the rest into the state and
        recompute the feature rows of the touched months from it."""
        cleaned = clean_readings(batch, self.profile, remove_duplicates=False)
        accepted = self.seen.accept(cleaned, batch_id)
        parts = partial_daily(accepted.rows, self.profile, self.series_keys).withColumns({
            "year": F.year("date"), "month": F.month("date"), "batch_id": F.lit(int(batch_id))})
        written = sinks.write_parquet(parts, f"{self.path}/partials", partition_by=list(STATE_PARTITIONS),
                                      dynamic_partitions=True)
        if written.only:
            features = daily_features(self.daily(parts.schema, written.only), series_keys=self.series_keys)
            sinks.write_parquet(features, self.features_path, partition_by=list(PARTITION_COLUMNS), dynamic_partitions=True)
        return accepted

    def daily(self, schema: T.StructType, directories: tuple[str, ...]) -> DataFrame:
        """The daily table of the months that hold ``directories`` (of single batches)."""
        months = sorted({d.rpartition("/")[0] for d in directories})
        parts = (self.spark.read.schema(schema).option("basePath", f"{self.path}/partials").parquet(*months)
                 .drop(*STATE_PARTITIONS))
        return finish_daily(merge_partials(parts, self.series_keys), self.series_keys)

    def features(self) -> DataFrame:
        return self.spark.read.parquet(self.features_path)
