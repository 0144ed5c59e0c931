"""Daily grouped aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions.exprs import resolve
from stratus.profile import DAILY_METRICS, READINGS, Profile


def date_of(df: DataFrame, column: str, zone: str | None = None):
    """Calendar day of a timestamp/date/string column.

    timestamp_ntz and date are zone-free. An instant (timestamp) has its day in
    ``zone``, or in the session zone where none is given; text goes through
    try_to_date so a bad value yields null instead of an ANSI error.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        return F.try_to_date(F.col(column))
    if zone is not None and isinstance(dtype, T.TimestampType):
        # The cast drops the session zone that it also adds; from there to the zone asked for.
        return F.to_date(F.convert_timezone(F.current_timezone(), F.lit(zone),
                                            F.col(column).cast("timestamp_ntz")))
    return F.to_date(F.col(column))


def daily_agg(df: DataFrame, profile: Profile = READINGS,
              temperature_column: str | None = None, date_column: str | None = None,
              series_keys: tuple[str, ...] = (), zone: str | None = None) -> DataFrame:
    """One row per day (per series key, if given); days of instants in ``zone``.

    Output: [series keys], date, n_rows, unique_days, avg/max/min/std_tempC,
    then avg_<metric> for each metric present. ``unique_days`` is 1 for a real
    day and 0 for the null-date group (the distinct count of the group key),
    written as a constant so the plan has no distinct-aggregate stage.
    """
    date_col = resolve(df, date_column or profile.date_column)
    if date_col is None:
        raise ValueError(f"date column {date_column or profile.date_column!r} not found")
    temp_col = resolve(df, temperature_column or profile.temperature_column)
    exprs = [F.count(F.lit(1)).alias("n_rows")]
    if temp_col is not None:
        t = F.col(temp_col)
        exprs += [F.avg(t).alias("avg_tempC"), F.max(t).alias("max_tempC"),
                  F.min(t).alias("min_tempC"), F.stddev_samp(t).alias("std_tempC")]
    for metric, alias in DAILY_METRICS:
        name = resolve(df, metric)
        if name is not None:
            exprs.append(F.avg(F.col(name)).alias(alias))
    keys = [F.col(k) for k in series_keys]
    grouped = df.groupBy(*keys, date_of(df, date_col, zone).alias("date")).agg(*exprs)
    unique_days = F.when(F.col("date").isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long")
    rest = [c for c in grouped.columns if c not in (*series_keys, "date", "n_rows")]
    return grouped.select(*series_keys, "date", "n_rows", unique_days.alias("unique_days"), *rest)
