import datetime as dt

from pyspark.sql import functions as F

from stratus.operators import clean_readings, daily_agg, filter_invalid, standardize_columns
from stratus.operators import quality
from stratus.operators.clean import dedup_exact, drop_critical_nulls
from stratus.profile import READINGS
from tests.fixtures import READING_SCHEMA, reading


def test_dedup_and_rename(spark):
    df = spark.createDataFrame([("2010-01-01 00:00:00", 20.5), ("2010-01-01 00:00:00", 20.5)],
                               "`Formatted Date` string, `Temperature (C)` double")
    out = clean_readings(df, READINGS)
    assert out.count() == 1
    assert "temperatureC" in out.columns and "formatted_date" in out.columns


def test_standardize_case_insensitive(spark):
    df = spark.createDataFrame([(1.0, 0.5)], "`temperature (c)` double, `HUMIDITY` double")
    assert standardize_columns(df).columns == ["temperatureC", "humidity"]


def test_daily_values_string_dates(spark):
    df = spark.createDataFrame(
        [("2010-01-01 10:00:00", 20.0), ("2010-01-01 11:00:00", 25.0), ("2010-01-02 10:00:00", 15.0)],
        "`Formatted Date` string, `Temperature (C)` double")
    rows = {r["date"]: r for r in daily_agg(clean_readings(df)).collect()}
    assert len(rows) == 2
    a, b = rows[dt.date(2010, 1, 1)], rows[dt.date(2010, 1, 2)]
    assert (a.avg_tempC, a.max_tempC, a.min_tempC, a.n_rows, a.unique_days) == (22.5, 25.0, 20.0, 2, 1)
    assert (b.avg_tempC, b.max_tempC, b.min_tempC) == (15.0, 15.0, 15.0)
    assert b.std_tempC is None


def test_null_policy(spark):
    ts = dt.datetime(2020, 1, 1)
    rows = [reading(1, ts, pressure=None), reading(2, ts, pressure=1000.0)]
    df = spark.createDataFrame(rows, READING_SCHEMA)
    assert filter_invalid(df, READINGS, "drop").count() == 1
    assert filter_invalid(df, READINGS, "keep").count() == 2
    with_bad = spark.createDataFrame(rows + [reading(3, ts, pressure=0.0)], READING_SCHEMA)
    assert filter_invalid(with_bad, READINGS, "drop").count() == 1
    assert filter_invalid(with_bad, READINGS, "keep").count() == 2


def test_null_date_group(spark):
    rows = [reading(1, None, temp=5.0), reading(2, dt.datetime(2020, 1, 1), temp=6.0)]
    df = spark.createDataFrame(rows, READING_SCHEMA)
    out = daily_agg(df).collect()
    by_date = {r.date: r for r in out}
    assert by_date[None].unique_days == 0 and by_date[None].n_rows == 1
    assert by_date[dt.date(2020, 1, 1)].unique_days == 1


def test_dedup_hot_row(spark):
    ts = dt.datetime(2020, 1, 1)
    rows = [reading(1, ts)] * 500 + [reading(2, ts)]
    df = spark.createDataFrame(rows, READING_SCHEMA).repartition(8)
    assert dedup_exact(df).count() == 2


def test_clean_counts_match_rules(spark):
    from stratus.sources.readings import readings
    r = readings(spark, "/root/testdata/sf0.001")
    c = clean_readings(r)
    assert c.count() == c.dropDuplicates().count()
    assert c.where(F.col("temperatureC").isNull() | (F.col("pressure_millibars") < 800)).count() == 0


def test_nan_temperature_is_a_value_not_a_null(spark):
    # Only nulls are critical; NaN stays (and counts as above the range maximum).
    ts = dt.datetime(2020, 1, 1)
    df = spark.createDataFrame([reading(1, ts, temp=float("nan")), reading(2, ts, temp=None),
                                reading(3, None)], READING_SCHEMA)
    kept = drop_critical_nulls(df).collect()
    assert [r.reading_id for r in kept] == [1]
    assert clean_readings(df).count() + sum(r.copies for r in quality.quarantine_rows(df).collect()) == 3
