"""Stores fed batch by batch: rows seen, daily state, late rows, sessions."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from stratus import sinks, streaming
from stratus.operators.clean import clean_readings, dedup_exact
from stratus.operators.daily import daily_agg
from stratus.operators.features import daily_features
from stratus.plans import daily_state, seen_rows
from stratus.plans.inspect import plan_text
from stratus.plans.seen_rows import SeenRows, digest
from tests.fixtures import READING_SCHEMA, reading


def _rows(df):
    return sorted(map(repr, df.collect()))


def _batches(spark, n=3, size=150):
    rng = random.Random(11)
    schema = "a string, b string, x double, `odd name` int"
    values = [(rng.choice(["p", "q", None]), rng.choice(["p", "", None]), rng.choice([0.0, -0.0, float("nan"), 1.5, None]), rng.randrange(40))
              for _ in range(400)]
    return [spark.createDataFrame([rng.choice(values) for _ in range(size)], schema) for _ in range(n)], schema


@pytest.mark.parametrize("words", [1, 64, 1 << 16])
def test_batches_together_give_the_distinct_rows(spark, tmp_dir, words):
    batches, _ = _batches(spark)
    seen = SeenRows(spark, os.path.join(tmp_dir, "s"), words=words, prefixes=3)
    got = [seen.accept(b, i) for i, b in enumerate(batches)]
    whole, new = batches[0], got[0].rows
    for b, g in zip(batches[1:], got[1:]):
        whole, new = whole.unionByName(b), new.unionByName(g.rows)
    assert _rows(new) == _rows(dedup_exact(whole)) and new.columns == whole.columns
    assert got[0].n_possible == 0 and got[0].n_new == got[0].n_distinct
    for g in got[1:]:
        assert g.n_rows == 150 and g.n_distinct - g.n_new <= g.n_possible <= g.n_distinct
    if words == 1:  # one word fills up: everything is looked up, results are the same
        assert got[2].n_possible == got[2].n_distinct > got[2].n_distinct - got[2].n_new
    again = seen.accept(batches[1], 1)
    assert _rows(again.rows) == _rows(got[1].rows)
    assert seen.accept(whole, 3).n_new == 0
    assert seen.accept(whole.limit(0), 4).n_rows == 0


def test_digest_tells_where_nulls_stand(spark):
    df = spark.createDataFrame([("x", None), (None, "x"), (None, None), ("x", "x")], "a string, b string")
    assert df.select(digest(["a", "b"], 1)).distinct().count() == 4


def _readings(spark, seed, n=400):
    rng = random.Random(seed)
    rows = [reading(rng.randrange(150), dt.datetime(2020, 1, 1) + dt.timedelta(hours=7 * rng.randrange(400))) for _ in range(n)]
    return spark.createDataFrame(rows, READING_SCHEMA)


def test_merged_state_equals_the_full_recompute(spark, tmp_dir):
    batches = [_readings(spark, s) for s in (1, 2)] + [_readings(spark, 1).limit(50)]
    state = daily_state.DailyState(spark, os.path.join(tmp_dir, "d"), words=1 << 12)
    for i, b in enumerate(batches):
        state.add(b, i)
    whole = batches[0].unionByName(batches[1])
    want = daily_features(daily_agg(clean_readings(whole)))

    def rounded(df):
        kinds = dict(df.dtypes)
        return _rows(df.select(*[F.round(c, 7).alias(c) if kinds[c] == "double" else c for c in want.columns]))
    assert rounded(state.features()) == rounded(want)
    before = rounded(state.features())
    state.add(batches[1], 1)  # the same batch again, as after a failure
    assert rounded(state.features()) == before


def test_merge_of_partials(spark):
    rng = random.Random(2)
    day = dt.datetime(2020, 3, 1, 5)
    base = spark.createDataFrame([reading(i, day) for i in range(60)], READING_SCHEMA)
    values = [1e6 + rng.random() for _ in range(60)]
    df = base.withColumn("temperatureC", F.element_at(F.array(*map(F.lit, values)), F.col("reading_id").cast("int") + 1))
    df = df.withColumn("temperatureC", F.when(F.col("reading_id") % 7 != 0, F.col("temperatureC")))
    parts = [daily_state.partial_daily(df.where(F.col("reading_id") % 4 == k)) for k in range(4)]
    merged = daily_state.finish_daily(daily_state.merge_partials(
        parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]))).first()
    want = daily_agg(df).first()
    assert merged.n_rows == 60 and abs(merged.std_tempC - want.std_tempC) < 1e-8 and abs(merged.avg_tempC - want.avg_tempC) < 1e-6
    assert (merged.min_tempC, merged.max_tempC) == (want.min_tempC, want.max_tempC)


def test_state_reads_touched_months_alone(spark, tmp_dir):
    state = daily_state.DailyState(spark, os.path.join(tmp_dir, "d"), words=64)
    days = [dt.datetime(2020, m, 5, 3) for m in (1, 2, 3)]
    state.add(spark.createDataFrame([reading(i, t) for i, t in enumerate(days)], READING_SCHEMA), 0)
    schema = spark.read.parquet(f"{state.path}/partials").schema
    opened = state.daily(schema, (f"{state.path}/partials/year=2020/month=2/batch_id=0",))
    assert all("month=2/" in f for f in opened.inputFiles()) and opened.count() == 1
    assert plan_text(opened).split("\n\n")[0].count("Exchange") == 1


EVENTS = "ts timestamp_ntz, user_id long, event_type string, value double"


def _events(rng, n, first, last):
    return [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(first * 1440, last * 1440)) if rng.random() > 0.02 else None,
             rng.choice([1, 1, 1, 2, 3, None]), rng.choice("ab"), float(rng.randrange(9))) for _ in range(n)]


def test_late_rows_are_counted_not_lost(spark, tmp_dir):
    rng = random.Random(7)
    turns = [_events(rng, 60, 0, 5), _events(rng, 60, 1, 9), [], _events(rng, 60, 2, 14)]
    days = streaming.LateAwareDays(spark, os.path.join(tmp_dir, "l"), dt.timedelta(days=2))
    want, late, last = {}, [], None
    for i, rows in enumerate(turns):
        df = spark.createDataFrame(rows, EVENTS)
        days.process(df, i)
        if i == 1:
            days.process(df, i)  # again, as after a failure
        bound = last - dt.timedelta(days=2) if last else None
        for ts, _, kind, value in rows:
            if ts is None or bound and dt.datetime.combine(ts.date() + dt.timedelta(days=1), dt.time()) <= bound:
                late.append((ts, kind, value))
            else:
                n, total = want.get((ts.date(), kind), (0, 0.0))
                want[ts.date(), kind] = (n + 1, total + value)
        last = max([t for t, *_ in rows if t] + ([last] if last else []))
        rows_in = sum(map(len, turns[:i + 1]))
        sums = [f.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for f in (days.closed(), days.open())]
        assert sum(sums) + days.late().count() == rows_in == days.ledger.rows().agg(F.sum("n_rows")).first()[0]
    both = {(r.day, r.event_type): (r.n, r.total) for r in days.closed().unionByName(days.open()).collect()}
    assert both == want and late
    assert sorted(map(repr, late)) == sorted(repr(tuple(r)) for r in days.late().select("ts", "event_type", "value").collect())
    assert {r.reason for r in days.late().collect()} == {"closed_day", "no_time"}


def _sessions(rows, gap):
    by, out = {}, []
    for ts, user, _, value in rows:
        if ts is not None:
            by.setdefault(user, []).append((ts, value))
    for user, events in by.items():
        events.sort()
        own = [events[0]]
        for e in events[1:] + [None]:
            if e is None or e[0] - own[-1][0] >= gap:
                out.append((user, own[0][0], own[-1][0], len(own), sum(v for _, v in own)))
                own = []
            own.append(e)
    return sorted(map(repr, out))


def test_sessions(spark, tmp_dir):
    rng, gap, delay = random.Random(8), dt.timedelta(hours=3), dt.timedelta(hours=5)
    turns = [_events(rng, 80, 0, 4), _events(rng, 80, 3, 8), _events(rng, 80, 8, 9), _events(rng, 40, 2, 12)]
    rows = [r for t in turns for r in t]
    batch = streaming.session_windows(spark.createDataFrame(rows, EVENTS), "user_id", "ts", "value", gap)
    assert sorted(map(repr, map(tuple, batch.collect()))) == _sessions(rows, gap)
    stream = streaming.SessionStream(spark, os.path.join(tmp_dir, "s"), "user_id", "ts", "value", gap, delay)
    on_time, n_late, last = [], 0, None
    for i, t in enumerate(turns):
        stream.process(spark.createDataFrame(t, EVENTS), i)
        if i == 2:
            stream.process(spark.createDataFrame(t, EVENTS), i)
        good = [r for r in t if r[0] is not None and (last is None or r[0] >= last - delay)]
        on_time, n_late = on_time + good, n_late + len(t) - len(good)
        last = max([r[0] for r in t if r[0]] + ([last] if last else []))
    both = stream.emitted("bigint").unionByName(stream.open("bigint"))
    assert sorted(map(repr, map(tuple, both.collect()))) == _sessions(on_time, gap)
    assert stream.late().count() == n_late > 10 and stream.emitted("bigint").count() > 10


def test_update_mode_keeps_the_latest_row(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, n) for n in ("src", "out", "ck"))
    schema = "ts timestamp_ntz, event_type string, value double"
    for value in (1.0, 5.0):
        spark.createDataFrame([(dt.datetime(2024, 1, 1, 3), "a", value)], schema).write.mode("append").parquet(src)
        got = streaming.daily_event_stream(spark, src, "*.parquet", spark.read.parquet(src).schema, out, ck).collect()
    assert [tuple(r) for r in got] == [(dt.date(2024, 1, 1), "a", 2, 3.0)]
    assert len([d for d in os.listdir(out) if d.startswith("batch_id=")]) == 2


def test_stream_store_batches_merge(spark, tmp_dir):
    """Old batch directories of a month become one file; the last batch stays as it is."""
    from stratus.plans import incremental
    store = os.path.join(tmp_dir, "store")
    for i in range(5):
        incremental.store_batch(spark.createDataFrame([reading(i, dt.datetime(2020, 1 + i % 2, 5))], READING_SCHEMA), store, i)
    before = _rows(spark.read.parquet(store).drop("batch_id"))
    done = incremental.merge_batches(spark, store, before_batch=4).collect()
    assert {r.directory for r in done} == {"reading_year=2020/reading_month=1/batch_id=-1", "reading_year=2020/reading_month=2/batch_id=-1"}
    assert _rows(spark.read.parquet(store).drop("batch_id")) == before
    assert len(spark.read.parquet(store).inputFiles()) == 3
    assert sinks.recover(spark, store) == {"undone": 0, "finished": 0}


def test_live_quality_adds_up_and_replays(spark, tmp_dir):
    from stratus.operators.quality import completeness, range_violations
    whole = _readings(spark, 4, 900).withColumn("summary", F.when(F.col("reading_id") % 5 == 0, "").otherwise(F.col("summary")))
    live = streaming.LiveQuality(spark, os.path.join(tmp_dir, "q"))
    with pytest.raises(FileNotFoundError):
        live.summary()
    for i in range(3):
        live.process(whole.where(F.col("reading_id") % 3 == i), i)
    live.process(whole.where(F.col("reading_id") % 3 == 1), 1)  # again, as after a failure
    live.process(whole.limit(0), 3)
    got = {r.field: r for r in live.summary((0.1, 0.9)).collect()}
    assert set(got) == set(whole.columns)
    exact = whole.agg(*[F.count_distinct(c).alias(c) for c in whole.columns]).first()
    for c, r in got.items():
        values = whole.agg(F.count_if(F.col(c).isNull()), F.count("*")).first()
        assert (r.nulls, r.n_rows) == tuple(values)
        assert abs(r.distinct - exact[c]) <= max(1, 0.03 * exact[c])
    t = whole.agg(F.min("temperatureC"), F.max("temperatureC"), F.count_if(F.col("temperatureC") > 60),
                  F.percentile("temperatureC", F.array(F.lit(0.07), F.lit(0.13), F.lit(0.87), F.lit(0.93)))).first()
    r = got["temperatureC"]
    assert (r.min, r.max, r.above) == tuple(t)[:3]
    assert t[3][0] <= r.quantiles[0] <= t[3][1] and t[3][2] <= r.quantiles[1] <= t[3][3]
    assert got["summary"].empty == whole.where("summary = ''").count() and got["reading_id"].quantiles is None


@pytest.mark.parametrize("words", [4, 1 << 12])
def test_seen_rows_are_written_once_and_looked_up_where_they_stand(spark, tmp_dir, monkeypatch, words):
    batches, _ = _batches(spark, n=4)
    writes, write = [], seen_rows.sinks.write_parquet

    def kept(df, path, **options):
        writes.append((os.path.basename(path).rsplit("-", 1)[0], df.columns))
        return write(df, path, **options)
    monkeypatch.setattr(seen_rows.sinks, "write_parquet", kept)
    seen = SeenRows(spark, os.path.join(tmp_dir, "s"), words=words, prefixes=2)
    # Batches 1 and 2 do not see each other's digests, so the index holds some twice.
    for i in (2, 1):
        seen.accept(batches[i], i)
    got = seen.accept(batches[1].unionByName(batches[2]).unionByName(batches[3]), 3)
    whole = _rows(dedup_exact(batches[1].unionByName(batches[2])))
    assert _rows(got.rows) == sorted(set(_rows(dedup_exact(batches[3]))) - set(whole))
    assert got.n_rows == 450 and got.n_distinct == len(set(_rows(dedup_exact(batches[3]))) | set(whole))
    assert [name for name, columns in writes if "a" in columns] == ["seen-probed"] * 3
