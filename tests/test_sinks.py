import datetime as dt
import glob
import os

import pytest

from pyspark.sql import functions as F

from stratus import sinks
from stratus.sinks import files
from stratus.sources import read_parquet

F3 = [(dt.date(2031, 5, 3), -3.25, 0.5, -9.75, 11.0), (dt.date(2031, 5, 7), 1.0, 6.5, -2.0, 3.0),
      (dt.date(2032, 2, 29), 30.125, 41.0, 17.5, 1.0)]
F3_SCHEMA = "date date, avg_tempC double, max_tempC double, min_tempC double, n_rows double"
TEXT_SCHEMA = "i int, text string, seen timestamp, local timestamp_ntz, x double"
TEXTS = ["plain", "two\nlines", "cr\r\nlf", 'a "quote"', 'comma, and \\ backslash', "", None, "  blanks  ", "ünï 漢", '"', "\\"]


def _texts(spark):
    at = dt.datetime(2031, 1, 2, 3, 4, 5, 678901)
    rows = [(i, t, at + dt.timedelta(microseconds=i), at if i % 2 else None, float("nan") if i == 3 else i / 3)
            for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, TEXT_SCHEMA)


def _f3(spark):
    return spark.createDataFrame(F3, F3_SCHEMA)


def test_parquet_roundtrip_verified(spark, tmp_dir):
    res = sinks.write_parquet(_f3(spark), os.path.join(tmp_dir, "p"))
    assert res.expected_rows == 3
    v = res.verification(spark).collect()[0]
    assert v.valid and v.actual_rows == 3 and v.actual_columns == 5
    assert sorted(tuple(r) for r in read_parquet(spark, res.path).collect()) == F3


def test_partitioned_and_gzip(spark, tmp_dir):
    res = sinks.write_parquet(_f3(spark), os.path.join(tmp_dir, "pp"), partition_by=["date"],
                              compression="gzip")
    assert len(glob.glob(os.path.join(res.path, "date=*"))) == 3
    assert glob.glob(os.path.join(res.path, "date=*", "*.gz.parquet"))
    back = read_parquet(spark, res.path)
    assert back.count() == 3 and back.columns[-1] == "date"
    assert res.verification(spark).collect()[0].valid


def test_csv_json_roundtrip(spark, tmp_dir):
    for writer in (sinks.write_csv, sinks.write_json):
        res = writer(_f3(spark), os.path.join(tmp_dir, writer.__name__))
        back = sinks.read_back(spark, res)
        assert sorted(tuple(r) for r in back.collect()) == F3
        assert res.verification(spark).collect()[0].valid


def test_json_keeps_null_columns(spark, tmp_dir):
    df = spark.createDataFrame([(1, None)], "a int, b double")
    res = sinks.write_json(df, os.path.join(tmp_dir, "j"))
    assert spark.read.json(res.path).columns == ["a", "b"]


def test_multi_format_and_summary(spark, tmp_dir):
    with pytest.warns(UserWarning, match="xml"):
        results = sinks.write_multiple_formats(_f3(spark), tmp_dir, ("parquet", "csv", "json", "xml"))
    assert sorted(results) == ["csv", "json", "parquet"]
    summary = {r.format: r for r in sinks.load_summary(spark, results).collect()}
    assert all(summary[f].n_files >= 1 and summary[f].total_bytes > 0 for f in results)
    assert all((summary[f].n_rows, summary[f].n_columns) == (3, 5) for f in results)


def test_no_known_format_is_an_error_before_any_job(spark, tmp_dir):
    with pytest.warns(UserWarning), pytest.raises(ValueError):
        sinks.write_multiple_formats(_f3(spark), tmp_dir, ("xml",))
    assert os.listdir(tmp_dir) == []


@pytest.mark.parametrize("order", [("csv", "json", "parquet"), ("json", "parquet", "csv"), ("parquet", "csv", "json")])
def test_texts_survive_every_format_order(spark, tmp_dir, order):
    df = _texts(spark)
    results = sinks.write_multiple_formats(df, tmp_dir, order)
    want = sorted(map(repr, df.collect()))
    for res in results.values():
        assert sorted(map(repr, sinks.read_back(spark, res).collect())) == want
        assert res.verification(spark).first().valid


@pytest.mark.parametrize("options", [{"sep": ";"}, {"header": False}, {"sep": "\t", "header": False, "compression": "gzip"}])
def test_csv_is_read_as_it_was_written(spark, tmp_dir, options):
    res = sinks.write_csv(_texts(spark), os.path.join(tmp_dir, "c"), **options)
    assert sorted(map(repr, sinks.read_back(spark, res).collect())) == sorted(map(repr, _texts(spark).collect()))


def test_a_lossy_write_raises(spark, tmp_dir):
    with pytest.raises(sinks.VerificationError):  # seconds only
        sinks.write_csv(_texts(spark), os.path.join(tmp_dir, "l"), timestamp_format="yyyy-MM-dd HH:mm:ss")
    with pytest.raises(sinks.VerificationError):  # blank lines
        sinks.write_csv(spark.createDataFrame([(None,), ("a",)], "a string"), os.path.join(tmp_dir, "n"))


def test_dynamic_overwrite_and_append_are_checked_on_what_they_wrote(spark, tmp_dir):
    path = os.path.join(tmp_dir, "d")
    sinks.write_parquet(_f3(spark), path, partition_by=["date"])
    day = spark.createDataFrame([(F3[0][0], 9.0, 9.0, 9.0, 9.0), (None, 1.0, 1.0, 1.0, 1.0)], F3_SCHEMA)
    res = sinks.write_parquet(day, path, partition_by=["date"], dynamic_partitions=True)
    assert res.verification(spark).first().valid and read_parquet(spark, path).count() == 4
    more = sinks.write_parquet(_f3(spark), path, partition_by=["date"], mode="append")
    assert more.expected_rows == 3 and read_parquet(spark, path).count() == 7
    first = sinks.write_json(_f3(spark), os.path.join(tmp_dir, "j"), mode="append")
    assert first.verification(spark).first().valid


def test_sorted_output(spark, tmp_dir):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("n")).repartition(6)
    res = sinks.write_parquet(df, os.path.join(tmp_dir, "s"), sort_by=("n",))
    files = sorted(glob.glob(os.path.join(res.path, "part-*")))
    rows = [r.n for f in files for r in spark.read.parquet(f).collect()]
    assert rows == sorted(rows) and len(rows) == 1000


def test_verification_detects_change(spark, tmp_dir):
    res = sinks.write_parquet(_f3(spark), os.path.join(tmp_dir, "v"))
    spark.createDataFrame(F3[:2], F3_SCHEMA).write.mode("overwrite").parquet(res.path)
    v = res.verification(spark).collect()[0]
    assert not v.valid and v.actual_rows == 2


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_a_failed_check_leaves_the_old_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "kept")
    good = spark.createDataFrame([("a", dt.datetime(2031, 1, 1, 2, 3, 4))], "a string, t timestamp")
    sinks.write_csv(good, path, timestamp_format="yyyy-MM-dd HH:mm:ss")
    lossy = good.withColumn("t", F.expr("t + interval 5 microsecond"))
    with pytest.raises(sinks.VerificationError):
        sinks.write_csv(lossy, path, timestamp_format="yyyy-MM-dd HH:mm:ss")
    assert spark.read.option("header", True).csv(path).count() == 1
    other = sinks.write_parquet(_f3(spark).limit(1), os.path.join(tmp_dir, "other"))
    table = os.path.join(tmp_dir, "table")
    for options in ({}, {"mode": "append"}, {"partition_by": ["date"], "dynamic_partitions": True}):
        first = {"partition_by": options["partition_by"]} if "partition_by" in options else {}
        sinks.write_parquet(_f3(spark), table, **first)
        before = _rows(read_parquet(spark, table))
        with pytest.raises(sinks.VerificationError):  # held against another write
            sinks.write_parquet(_f3(spark), table, verify=other, **options)
        assert _rows(read_parquet(spark, table)) == before
    assert sorted(os.listdir(tmp_dir)) == ["kept", "other", "table"]  # nothing is left beside them


def test_a_check_opens_only_what_was_written(spark, tmp_dir):
    path = os.path.join(tmp_dir, "months")
    df = spark.range(400).select("id", (F.col("id") % 40).cast("int").alias("m"))
    sinks.write_parquet(df, path, partition_by=["m"])
    one = sinks.write_parquet(df.where("m = 7"), path, partition_by=["m"], dynamic_partitions=True)
    opened = sinks.read_back(spark, one).inputFiles()
    assert opened and all("/m=7/" in f for f in opened)
    more = sinks.write_parquet(df.where("m = 9"), path, partition_by=["m"], mode="append")
    opened = sinks.read_back(spark, more).inputFiles()
    assert opened and all("/m=9/" in f for f in opened) and len(opened) < len(glob.glob(f"{path}/m=9/part-*"))
    assert more.verification(spark).first().valid and one.verification(spark).first().valid
    back = {r.m: r.n for r in spark.read.parquet(path).groupBy("m").agg(F.count("*").alias("n")).collect()}
    assert back == {m: 20 if m == 9 else 10 for m in range(40)}
    empty = sinks.write_parquet(df.where("m > 99"), path, partition_by=["m"], dynamic_partitions=True)
    assert empty.expected_rows == 0 and empty.only == () and spark.read.parquet(path).count() == 410


def test_writes_over_what_they_read_and_existing_targets(spark, tmp_dir):
    path = os.path.join(tmp_dir, "self")
    sinks.write_parquet(_f3(spark), path)
    sinks.write_parquet(read_parquet(spark, path).limit(2), path)
    assert read_parquet(spark, path).count() == 2
    with pytest.raises(FileExistsError):
        sinks.write_parquet(_f3(spark), path, mode="errorifexists")
    with pytest.raises(ValueError):
        sinks.write_parquet(_f3(spark), path, mode="ignore")
    sinks.write_parquet(_f3(spark).limit(0), os.path.join(tmp_dir, "none"), partition_by=["date"])


def test_versions(spark, tmp_dir):
    table = sinks.VersionedTable(spark, os.path.join(tmp_dir, "v"))
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.history().count() == 0
    assert table.publish(_f3(spark).limit(2)).number == 1
    plan = table.read()
    with pytest.raises(sinks.VerificationError, match="some_rows"):
        table.publish(_f3(spark).limit(0), require={"some_rows": F.count("*") > 0, "known": F.count("date") >= 0})
    assert table.read().count() == 2
    assert table.publish(_f3(spark), partition_by=["date"], require={"some_rows": F.count("*") > 0}).number == 2
    assert table.read().count() == 3 and table.read(1).count() == 2 and plan.count() == 2
    history = {r.version: (r.n_rows, r.live) for r in table.history().collect()}
    assert history == {1: (2, False), 2: (3, True)}
    from stratus.sinks import paths
    assert paths.claim(spark, f"{table.path}/claims/3")  # another writer was faster, or died
    assert table.publish(_f3(spark)).number == 4
    assert table.expire(keep=1) == [1, 2] and table.read().count() == 3
    assert len(os.listdir(f"{table.path}/data")) == 1
    with pytest.raises(FileNotFoundError):
        table.read(2)


def test_first_fit():
    from stratus.sinks.compaction import first_fit
    sizes = [(s, ("d", f"f{i}")) for i, s in enumerate([7, 5, 4, 3, 1, 9, 2])]
    assert [[s for s, _ in b] for b in first_fit(sizes, 10)] == [[9, 1], [7, 3], [5, 4], [2]]
    assert [[s for s, _ in b] for b in first_fit([(1, ("", str(i))) for i in range(10)], 3)] == [[1] * 3] * 3 + [[1]]
    assert first_fit([], 5) == []


def _many_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "small")
    df = spark.range(600).select("id", F.concat(F.lit("p q:"), (F.col("id") % 3).cast("string")).alias("k"), F.lit("x y").alias("t"))
    df.repartition(12).write.partitionBy("k").parquet(path)
    df.where("id = 1").write.mode("append").partitionBy("k").parquet(path)
    return path, _rows(spark.read.parquet(path))


def test_compaction(spark, tmp_dir):
    path, before = _many_files(spark, tmp_dir)
    one = os.path.getsize(glob.glob(f"{path}/k=*/part-*")[0])
    done = sinks.compact_files(spark, path, target_bytes=5 * one, small_bytes=4 * one).collect()
    assert _rows(spark.read.parquet(path)) == before
    files = {d: len(os.listdir(d)) for d in glob.glob(f"{path}/k=*")}
    assert len(done) >= 6 and sum(r.files for r in done) >= 30
    for d in glob.glob(f"{path}/k=*"):
        mine = [r for r in done if os.path.basename(d) == r.directory]
        left = [f for f in os.listdir(d) if f.endswith(".parquet")]
        assert {r.file for r in mine} <= set(left) and len(left) <= len(mine) + 1 and len(left) <= 4
    assert files and not [f for f in glob.glob(f"{path}/**/_*", recursive=True) if "_SUCCESS" not in f]
    assert sinks.compact_files(spark, path, target_bytes=one, small_bytes=1).count() == 0


@pytest.mark.parametrize("dies_at", [1, 3, 9])
def test_a_compaction_that_dies_is_recovered(spark, tmp_dir, monkeypatch, dies_at):
    from stratus.sinks import paths
    path, before = _many_files(spark, tmp_dir)
    move, calls = paths.move, [0]

    def failing(*args):
        calls[0] += 1
        if calls[0] == dies_at:
            raise OSError("gone")
        return move(*args)
    monkeypatch.setattr(paths, "move", failing)
    one = os.path.getsize(glob.glob(f"{path}/k=*/part-*")[0])
    with pytest.raises(OSError):
        sinks.compact_files(spark, path, target_bytes=4 * one, small_bytes=3 * one)
    monkeypatch.setattr(paths, "move", move)
    sinks.recover(spark, path)
    assert _rows(spark.read.parquet(path)) == before
    assert not [f for f in glob.glob(f"{path}/**/_*", recursive=True) if "_SUCCESS" not in f]
    assert sinks.recover(spark, path) == {"undone": 0, "finished": 0}


@pytest.mark.parametrize("verify", [True, False])
def test_fan_out_keeps_one_copy_of_each_format(spark, tmp_dir, monkeypatch, verify):
    monkeypatch.setattr(files, "RECORDS_PER_FILE", 10)
    monkeypatch.setattr(files, "shared_dir", lambda spark, name: os.path.join(tmp_dir, "shared", name))
    df = spark.range(45).coalesce(1).selectExpr("id", "concat('a\\n', id) AS note")
    for formats in (("csv", "parquet", "json"), ("json", "csv")):
        at = os.path.join(tmp_dir, "-".join(formats))
        results = sinks.write_multiple_formats(df, at, formats, verify=verify)
        assert list(results) == list(formats)
        assert sorted(os.listdir(at)) == sorted(f"data.{f}" for f in formats)
        assert not os.path.exists(os.path.join(tmp_dir, "shared", "fan-out"))
        for fmt, r in results.items():
            assert r.verification(spark).first()["valid"] and r.path == os.path.join(at, f"data.{fmt}")
            assert sorted(map(tuple, sinks.read_back(spark, r).collect())) == sorted(map(tuple, df.collect()))
            names = [n for n in os.listdir(r.path) if n.startswith("part-")]
            assert len(names) == 1 if fmt == "parquet" else len(names) == 5 and all(n.endswith(".gz") for n in names)
    plain = sinks.write_multiple_formats(df, os.path.join(tmp_dir, "plain"), ("csv",), compression=None)["csv"]
    assert all(n.endswith(".csv") for n in os.listdir(plain.path) if n.startswith("part-"))
