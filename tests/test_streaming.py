import datetime as dt
import os
import warnings

import pytest
from pyspark.sql import functions as F

from stratus import streaming
from stratus.operators import analytics
from stratus.operators.clean import clean_readings
from stratus.operators.policy import QualityError, apply_policy
from stratus.plans import incremental
from stratus.plans.inspect import plan_text
from stratus.sources.readings import readings, table
from tests.fixtures import READING_SCHEMA, reading

SF = "/root/testdata/sf0.001"


def test_closed_windows_equal_batch_aggregate(spark, tmp_dir):
    events = table(spark, SF, "events")
    out = streaming.closed_window_stream(spark, SF, "events.parquet", events.schema,
                                         os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    emitted = {(r.window_start.date(), r.event_type): (r.n, round(r.avg_value, 9))
               for r in out.collect()}
    batch = {(r.d, r.event_type): (r.n, round(r.avg_value, 9)) for r in
             events.groupBy(F.to_date("ts").alias("d"), "event_type")
             .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("avg_value")).collect()}
    last_day = max(d for d, _ in batch)
    # Only windows the watermark (max event time - 1 day) has closed are emitted,
    # and each emitted window is complete.
    assert emitted and all(batch[k] == v for k, v in emitted.items())
    assert all(d <= last_day - dt.timedelta(days=1) for d, _ in emitted)
    assert {d for d, _ in emitted} >= {d for d, _ in batch if d <= last_day - dt.timedelta(days=2)}


def test_stored_batch_replay_is_idempotent(spark, tmp_dir):
    r = readings(spark, SF)
    store, out = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "features")
    first = r.where(F.col("formatted_date") < F.lit("1996-01-01").cast("timestamp_ntz"))
    empty = r.where(F.lit(False))
    assert incremental.store_batch(empty, store, 7) == incremental.StoredBatch(0, ())
    stored = incremental.store_batch(first, store, 0)
    assert stored.rows == first.count()
    assert stored.months == tuple(sorted(
        (r[0], r[1]) for r in first.select(F.year("formatted_date"), F.month("formatted_date"))
        .distinct().collect()))
    incremental.apply_stored_batch(spark, store, r.schema, out, stored.months)
    before = sorted(tuple(x) for x in spark.read.parquet(out).collect())
    incremental.store_batch(first, store, 0)  # the same batch again, as after a failure
    incremental.apply_stored_batch(spark, store, r.schema, out, stored.months)
    assert spark.read.parquet(store).count() == first.count()
    assert sorted(tuple(x) for x in spark.read.parquet(out).collect()) == before


def test_stored_batch_reads_only_touched_months(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    ts = [dt.datetime(2020, 1, 5), dt.datetime(2020, 2, 5), dt.datetime(2021, 3, 5)]
    for i, t in enumerate(ts):
        incremental.store_batch(spark.createDataFrame([reading(i, t)], READING_SCHEMA), store, i)
    schema = spark.read.parquet(store).drop(*incremental.STORE_PARTITIONS).schema
    opened = incremental.stored_months(spark, store, schema, ((2020, 2), (2021, 3)))
    assert opened.count() == 2
    # Only the touched months' files are listed.
    assert len(opened.inputFiles()) == 2 and not any("reading_month=1" in f for f in opened.inputFiles())


def test_policy_raise_warn_quarantine(spark):
    r = readings(spark, SF)
    with pytest.raises(QualityError):
        apply_policy(r, on_fail="raise", as_of="2000-01-01 00:00:00")
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        out, rejected = apply_policy(r, on_fail="warn", as_of="2000-01-01 00:00:00")
    assert out is r and rejected is None and any("quality checks failed" in str(w.message) for w in seen)
    kept, rejected = apply_policy(r, on_fail="quarantine")
    assert kept.count() + sum(x.copies for x in rejected.collect()) == r.count()
    assert kept.count() == clean_readings(r).count()


def test_decomposition_one_exchange_and_series_apart(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(70)]
    rows = [(st, d, float((i * 7) % 11) + (5.0 if st == "b" else 0.0))
            for st in ("a", "b") for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "station string, date date, avg_tempC double")
    both = analytics.seasonal_decomposition(df, series_keys=("station",))
    text = plan_text(both)
    assert text.split("\n\n")[0].count("Exchange") == 1
    one = {r.date: r for r in analytics.seasonal_decomposition(df.where("station = 'a'").drop("station"))
           .collect()}
    for r in both.collect():
        ref = one[r.date]
        shift = 5.0 if r.station == "b" else 0.0
        assert r.observed == ref.observed + shift
        assert abs(r.trend - (ref.trend + shift)) < 1e-9 and abs(r.remainder - ref.remainder) < 1e-9


def test_late_rows_behind_watermark_are_dropped(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, n) for n in ("src", "out", "ck"))
    schema = "ts timestamp_ntz, event_type string, value double"

    def day(d, h=12):
        return dt.datetime(2024, 1, d, h)
    first = [(day(1), "a", 1.0), (day(2), "a", 2.0), (day(5), "a", 5.0)]
    spark.createDataFrame(first, schema).write.mode("append").parquet(src)
    streaming.closed_window_stream(spark, src, "*.parquet", spark.read.parquet(src).schema, out, ck)
    # Second run of the same query: a row for Jan 1 arrives after its window
    # closed (watermark Jan 4 12:00) and is dropped; Jan 6 advances the watermark.
    late = [(day(1, 13), "a", 100.0), (day(6), "a", 6.0), (day(8), "a", 8.0)]
    spark.createDataFrame(late, schema).write.mode("append").parquet(src)
    streaming.closed_window_stream(spark, src, "*.parquet", spark.read.parquet(src).schema, out, ck)
    got = {r.window_start.date().day: (r.n, r.avg_value) for r in spark.read.parquet(out).collect()}
    assert got[1] == (1, 1.0)  # the late row did not change the closed window
    assert got[2] == (1, 2.0) and got[5] == (1, 5.0) and got[6] == (1, 6.0)
    assert 8 not in got  # still open: watermark is Jan 7 12:00
