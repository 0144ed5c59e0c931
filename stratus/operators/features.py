"""Calendar, rolling-window and lag features over a daily frame.

``scope="month"`` (default) partitions every window by (series keys, year,
month of the date), so rolling values and lags restart on the 1st of each
month and frames count rows. ``scope="series"`` runs on through caller-given series and uses
calendar-day range frames (missing days are not counted as rows). A series is cut into
chunks of ``CHUNK_DAYS`` for that, and the last days of a chunk stand in the next one as
well, as many as the longest frame looks back; so one long series is many tasks.

All window columns share one partitioning and ordering and are added in one
``withColumns``, so the plan holds one Exchange, one Sort and one Window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions.exprs import is_weekend, resolve, season

CALENDAR_COLUMNS = ("year", "month", "day_of_week", "quarter")
ROLLING_COLUMNS = ("temp_7d_avg", "temp_30d_avg", "temp_7d_std", "temp_7d_min", "temp_7d_max")
LAG_COLUMNS = ("temp_change_1d", "temp_change_7d")
#: Days of a series that one window partition holds, and days that frames look back.
CHUNK_DAYS, HALO_DAYS = 360, 29


def _calendar(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day_of_week": F.dayofweek(date),
        "quarter": F.quarter(date),
    }


def _flags(date: Column) -> dict[str, Column]:
    return {"is_weekend": is_weekend(date), "season": season(F.month(date))}


def _with_partition_keys(df: DataFrame, date_column: str) -> DataFrame:
    # Real columns (not expressions in every window spec): one exchange.
    date = F.col(date_column)
    keep = [c for c in df.columns if c not in ("year", "month")]
    return df.select(*keep, F.year(date).alias("year"), F.month(date).alias("month"))


def _window_exprs(value: str, date_column: str, scope: str,
                  series_keys: tuple[str, ...]) -> dict[str, Column]:
    v = F.col(value)
    if scope == "month":
        base = Window.partitionBy(*series_keys, "year", "month").orderBy(date_column)
        w7, w30 = base.rowsBetween(-6, 0), base.rowsBetween(-29, 0)
        prev1, prev7 = F.lag(v, 1).over(base), F.lag(v, 7).over(base)
    elif scope == "series":
        if not series_keys:
            raise ValueError("scope='series' needs series_keys; a window without a "
                             "partition key would run in a single task")
        day = F.unix_date(F.col(date_column))
        base = Window.partitionBy(*series_keys, "_chunk").orderBy(day)
        w7, w30 = base.rangeBetween(-6, 0), base.rangeBetween(-29, 0)
        prev1 = F.first(v).over(base.rangeBetween(-1, -1))
        prev7 = F.first(v).over(base.rangeBetween(-7, -7))
    else:
        raise ValueError(f"scope must be 'month' or 'series', got {scope!r}")
    return {
        "temp_7d_avg": F.avg(v).over(w7),
        "temp_30d_avg": F.avg(v).over(w30),
        "temp_7d_std": F.stddev_samp(v).over(w7),
        "temp_7d_min": F.min(v).over(w7),
        "temp_7d_max": F.max(v).over(w7),
        "temp_change_1d": v - prev1,
        "temp_change_7d": v - prev7,
    }


def _windowed(df: DataFrame, columns: dict[str, Column], date_column: str, scope: str) -> DataFrame:
    """``df`` with window columns; in series scope over chunks with the days before them."""
    if scope != "series":
        return df.withColumns(columns)
    day = F.unix_date(F.col(date_column))
    ahead = F.pmod(day, F.lit(CHUNK_DAYS)) >= CHUNK_DAYS - HALO_DAYS
    copies = F.when(ahead, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    chunked = df.withColumn("_copy", F.explode(copies)).withColumn("_chunk", F.floor(day / CHUNK_DAYS) + F.col("_copy"))
    return chunked.withColumns(columns).where("_copy = 0").drop("_copy", "_chunk")


def calendar_features(df: DataFrame, date_column: str = "date") -> DataFrame:
    """year, month, day_of_week (1 = Sunday), quarter, is_weekend, season."""
    date = F.col(date_column)
    return df.withColumns({**_calendar(date), **_flags(date)})


def rolling_features(df: DataFrame, value: str = "avg_tempC", date_column: str = "date",
                     scope: str = "month", series_keys: tuple[str, ...] = ()) -> DataFrame:
    """7-row mean/std/min/max and 30-row mean of ``value``."""
    src = _with_partition_keys(df, date_column) if scope == "month" else df
    exprs = _window_exprs(value, date_column, scope, series_keys)
    return _windowed(src, {k: exprs[k] for k in ROLLING_COLUMNS}, date_column, scope)


def lag_features(df: DataFrame, value: str = "avg_tempC", date_column: str = "date",
                 scope: str = "month", series_keys: tuple[str, ...] = ()) -> DataFrame:
    """Change against 1 and 7 rows (month scope) or days (series scope) back."""
    src = _with_partition_keys(df, date_column) if scope == "month" else df
    exprs = _window_exprs(value, date_column, scope, series_keys)
    return _windowed(src, {k: exprs[k] for k in LAG_COLUMNS}, date_column, scope)


def daily_features(df: DataFrame, value: str = "avg_tempC", date_column: str = "date",
                   scope: str = "month", series_keys: tuple[str, ...] = ()) -> DataFrame:
    """Daily frame + calendar + rolling + lag + weekend/season columns.

    Column order: the input's columns, year, month, day_of_week, quarter, the
    rolling columns, the lag columns, is_weekend, season. Rolling and lag
    columns are skipped when ``value`` is absent.
    """
    date = F.col(date_column)
    src = _with_partition_keys(df, date_column)
    cols = {"day_of_week": F.dayofweek(date), "quarter": F.quarter(date)}
    present = resolve(df, value)
    if present is not None:
        cols.update(_window_exprs(present, date_column, scope, series_keys))
    cols.update(_flags(date))
    return _windowed(src, cols, date_column, scope if present is not None else "month")
