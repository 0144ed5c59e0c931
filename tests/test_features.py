import datetime as dt
import random

import pytest

from stratus.operators import calendar_features, daily_features, lag_features, rolling_features
from tests.fixtures import DAILY_SCHEMA, daily_rows


def _by_date(df):
    return {r["date"]: r for r in df.collect()}


def test_month_border_restarts(spark):
    rows = daily_rows(dt.date(2020, 1, 25), range(17))  # Jan 25 .. Feb 10
    out = _by_date(daily_features(spark.createDataFrame(rows, DAILY_SCHEMA)))
    feb1 = out[dt.date(2020, 2, 1)]
    assert feb1.temp_change_1d is None and feb1.temp_change_7d is None
    assert feb1.temp_7d_avg == feb1.avg_tempC and feb1.temp_7d_std is None
    assert out[dt.date(2020, 2, 2)].temp_change_1d == 1.0
    assert out[dt.date(2020, 2, 8)].temp_change_7d == 7.0
    assert out[dt.date(2020, 1, 31)].temp_7d_avg == sum(range(0, 7)) / 7


def test_missing_days_month_vs_series(spark):
    days = [dt.date(2020, 3, d) for d in (1, 2, 3, 9, 10)]
    rows = [(d, float(i), "s1") for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "date date, avg_tempC double, station string")
    month = _by_date(rolling_features(df))
    series = _by_date(rolling_features(df, scope="series", series_keys=("station",)))
    # Rows frame: Mar 9 sees the 4 rows Mar 1-9; calendar frame (Mar 3-9): Mar 3 and 9.
    assert month[dt.date(2020, 3, 9)].temp_7d_avg == 1.5
    assert series[dt.date(2020, 3, 9)].temp_7d_avg == 2.5
    # Mar 10: all 5 rows vs. the calendar week Mar 4-10 (Mar 9 and 10 only).
    assert month[dt.date(2020, 3, 10)].temp_7d_avg == 2.0
    assert series[dt.date(2020, 3, 10)].temp_7d_avg == 3.5
    lag_s = _by_date(lag_features(df, scope="series", series_keys=("station",)))
    assert lag_s[dt.date(2020, 3, 9)].temp_change_1d is None
    assert lag_s[dt.date(2020, 3, 10)].temp_change_1d == 1.0


def test_series_scope_needs_keys(spark):
    df = spark.createDataFrame(daily_rows(dt.date(2020, 1, 1), [1, 2]), DAILY_SCHEMA)
    with pytest.raises(ValueError):
        rolling_features(df, scope="series")


def test_calendar_values(spark):
    dates = [dt.date(2021, m, 1) for m in range(1, 13)] + [
        dt.date(2020, 2, 29), dt.date(2020, 12, 31), dt.date(2021, 1, 2), dt.date(2021, 1, 3)]
    df = spark.createDataFrame([(d, 0.0) for d in dates], DAILY_SCHEMA)
    out = _by_date(calendar_features(df))
    seasons = {m: out[dt.date(2021, m, 1)].season for m in range(1, 13)}
    assert [seasons[m] for m in (12, 1, 2)] == ["Winter"] * 3
    assert [seasons[m] for m in (3, 4, 5)] == ["Spring"] * 3
    assert [seasons[m] for m in (6, 7, 8)] == ["Summer"] * 3
    assert [seasons[m] for m in (9, 10, 11)] == ["Fall"] * 3
    assert out[dt.date(2021, 1, 2)].day_of_week == 7 and out[dt.date(2021, 1, 2)].is_weekend == 1
    assert out[dt.date(2021, 1, 3)].day_of_week == 1 and out[dt.date(2021, 1, 3)].is_weekend == 1
    assert out[dt.date(2020, 12, 31)].quarter == 4 and out[dt.date(2020, 12, 31)].is_weekend == 0
    assert out[dt.date(2020, 2, 29)].month == 2


def test_null_date_row(spark):
    df = spark.createDataFrame([(None, 1.0), (dt.date(2020, 1, 1), 2.0)], DAILY_SCHEMA)
    out = _by_date(daily_features(df))
    assert out[None].season == "Fall" and out[None].is_weekend == 0


def test_feature_columns_order(spark):
    df = spark.createDataFrame(daily_rows(dt.date(2020, 1, 1), [1, 2]), DAILY_SCHEMA)
    assert daily_features(df).columns == [
        "date", "avg_tempC", "year", "month", "day_of_week", "quarter", "temp_7d_avg",
        "temp_30d_avg", "temp_7d_std", "temp_7d_min", "temp_7d_max", "temp_change_1d",
        "temp_change_7d", "is_weekend", "season"]


def test_month_scope_keeps_series_apart(spark):
    rows = [(dt.date(2020, 1, d), float(d), s) for d in (1, 2, 3) for s in ("a", "b")]
    rows = [(d, v if s == "a" else 100 * v, s) for d, v, s in rows]
    df = spark.createDataFrame(rows, "date date, avg_tempC double, station string")
    out = {(r.station, r.date): r for r in daily_features(df, series_keys=("station",)).collect()}
    assert out[("a", dt.date(2020, 1, 3))].temp_7d_avg == 2.0
    assert out[("b", dt.date(2020, 1, 3))].temp_7d_avg == 200.0
    assert out[("b", dt.date(2020, 1, 2))].temp_change_1d == 100.0


def test_series_scope_runs_on_across_chunks_in_many_tasks(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from stratus.operators import features
    from stratus.plans.inspect import plan_text
    rng = random.Random(3)
    days = sorted(rng.sample(range(3000), 1800))
    df = spark.createDataFrame([("s", dt.date(2015, 1, 1) + dt.timedelta(days=d), float(rng.randrange(100))) for d in days]
                               + [("t", None, 1.0)], "station string, date date, avg_tempC double")
    got = features.daily_features(df, scope="series", series_keys=("station",))
    plain = Window.partitionBy("station").orderBy(F.unix_date("date"))
    want = df.select("station", "date", F.round(F.avg("avg_tempC").over(plain.rangeBetween(-29, 0)), 9).alias("m"),
                     F.first("avg_tempC").over(plain.rangeBetween(-7, -7)).alias("p"), "avg_tempC")
    left = sorted(map(repr, got.select("date", F.round("temp_30d_avg", 9), F.col("temp_change_7d")).collect()))
    assert len(left) == 1801
    a = {r.date: (r[1], r.temp_change_7d) for r in got.select("date", F.round("temp_30d_avg", 9), "temp_change_7d").collect()}
    b = {r.date: (r.m, None if r.p is None else r.avg_tempC - r.p) for r in want.where("date is not null").collect()}
    assert {k: v for k, v in a.items() if k} == b
    # Partitions of the window hold a chunk and its halo, never the series.
    assert "_chunk" in plan_text(got)
    chunked = features._windowed(df, {"n": F.count("*").over(Window.partitionBy("station", "_chunk"))}, "date", "series")
    assert chunked.agg(F.max("n")).first()[0] <= features.CHUNK_DAYS + features.HALO_DAYS
