import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.operators import quality
from stratus.sources import RAW_CONTRACT, read_csv, read_csv_glob
from tests.fixtures import write_f1


def test_csv_scan_contract(spark, tmp_dir):
    path = os.path.join(tmp_dir, "weather.csv")
    write_f1(path)
    df = read_csv(spark, path)
    assert df.count() == 2
    assert len(df.columns) == 12
    assert df.schema == RAW_CONTRACT
    assert quality.schema_check(df, RAW_CONTRACT).count() == 0


def test_csv_timestamp_zone(spark, tmp_dir):
    path = os.path.join(tmp_dir, "weather.csv")
    write_f1(path)
    df = read_csv(spark, path)
    days = {r[0] for r in df.select(F.to_date("Formatted Date")).collect()}
    assert days == {__import__("datetime").date(2031, 7, 14)}  # session zone is UTC


def test_csv_glob_two_files(spark, tmp_dir):
    for name in ("a.csv", "b.csv"):
        write_f1(os.path.join(tmp_dir, name))
    with open(os.path.join(tmp_dir, "notes.txt"), "w") as fh:
        fh.write("ignored")
    df = read_csv_glob(spark, tmp_dir, "*.csv", with_source=True)
    assert df.count() == 4
    assert df.select("source_file").distinct().count() == 2


def test_missing_file(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, os.path.join(tmp_dir, "nope.csv"))


def test_schema_failure(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bad.csv")
    with open(path, "w") as fh:
        fh.write("wrong_col1,wrong_col2\n1,2\n")
    with pytest.raises(ValueError):
        read_csv(spark, path)


def test_corrupt_record_and_quoted_newline(spark, tmp_dir):
    path = os.path.join(tmp_dir, "q.csv")
    with open(path, "w") as fh:
        fh.write('a,b\n1,"line one\nline two"\n2,"say ""hi"""\n3\n')
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    df = read_csv(spark, path, schema=schema, multi_line=True, corrupt_column="_corrupt",
                  validate_schema=False).cache()
    rows = {r["a"]: r for r in df.collect()}
    assert rows[1]["b"] == "line one\nline two"
    assert rows[2]["b"] == 'say "hi"'
    assert rows[3]["_corrupt"] is not None


def test_csv_glob_checks_every_header(spark, tmp_dir):
    write_f1(os.path.join(tmp_dir, "a.csv"))
    # Same number of columns, two of them renamed: read by position it would
    # pass silently; the per-file header check rejects it.
    from tests.fixtures import F1_HEADER, F1_ROWS
    with open(os.path.join(tmp_dir, "b.csv"), "w") as fh:
        fh.write(F1_HEADER.replace("Humidity", "Humid").replace("Summary,", "Sumary,", 1) + "\n")
        fh.write(F1_ROWS[0] + "\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_csv_glob(spark, tmp_dir, "*.csv").collect()
    assert read_csv_glob(spark, tmp_dir, "*.csv", validate_schema=False).count() == 3


def test_malformed_record_fails_by_default(spark, tmp_dir):
    path = os.path.join(tmp_dir, "q.csv")
    with open(path, "w") as fh:
        fh.write('a,b\n1,"line one\nline two"\n2,x\n')
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_csv(spark, path, schema=schema).collect()


def test_scan_csv_sets_every_bad_line_aside(spark, tmp_dir):
    from stratus.sources import scan_csv
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()),
                           T.StructField("c", T.DoubleType())])
    for name, body in (("1.csv", '1,"x, ""y""",2.5\n2,"open\nrest",1\n3,short\n4,a,1,2\nfive,a,1\n6,,\n'),
                       ("2.csv", "7, padded ,1e3\r\n")):
        with open(os.path.join(tmp_dir, name), "w", newline="") as fh:
            fh.write("a,b,c\n" + body)
    records, rejected = scan_csv(spark, tmp_dir, schema)
    assert sorted(tuple(r) for r in records.collect()) == [(1, 'x, "y"', 2.5), (6, None, None), (7, " padded ", 1000.0)]
    assert sorted(tuple(r) for r in rejected.collect()) == sorted([
        ('2,"open', "open_quote"), ('rest",1', "open_quote"), ("3,short", "fields"), ("4,a,1,2", "fields"), ("five,a,1", "value")])


@pytest.mark.parametrize("session_zone", ["UTC", "Europe/Budapest", "Asia/Tokyo"])
def test_day_in_an_explicit_zone(spark, tmp_dir, session_zone):
    from stratus.operators.daily import date_of
    path = os.path.join(tmp_dir, "weather.csv")
    write_f1(path)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        df = read_csv(spark, path)
        for zone, day in (("UTC", 14), ("Europe/Budapest", 15), ("America/New_York", 14)):
            days = {r[0].day for r in df.select(date_of(df, "Formatted Date", zone)).collect()}
            assert days == {day}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_blank_and_repeated_header_lines_are_accounted_for(spark, tmp_dir):
    from pyspark.sql import types as T

    from stratus.sources import scan_csv
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    for name, text in (("x.csv", "a,b\n1,p\n\na,b\n2,q\na,b\n"), ("y.csv", "a,b\r\n3,r\r\n\r\n")):
        with open(os.path.join(tmp_dir, name), "w", newline="") as f:
            f.write(text)
    records, rejected = scan_csv(spark, tmp_dir, schema)
    assert sorted(tuple(r) for r in records.collect()) == [(1, "p"), (2, "q"), (3, "r")]
    assert sorted(tuple(r) for r in rejected.collect()) == [("", "blank"), ("", "blank"), ("a,b", "header"), ("a,b", "header")]
