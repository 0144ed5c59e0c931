"""Records with line breaks, joined across the pieces of split files, against a whole-file reading."""

import collections
import os
import random

import pytest
from pyspark.sql import types as T

from stratus.plans.inspect import plan_text
from stratus.sources import records, scan_csv, whole_lines

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.DoubleType())])


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        f.write(text)


def _records(text, limit):
    """Joined lines of one file, read from its start: the definition, line after line."""
    out, open_lines = [], []
    for line in text.replace("\r\n", "\n").split("\n")[:-1]:
        odd = line.count('"') % 2 == 1
        if open_lines:
            open_lines.append(line)
            if odd:
                out += ["\n".join(open_lines)] if sum(len(x) + 1 for x in open_lines) <= limit else open_lines
                open_lines = []
        elif odd:
            open_lines = [line]
        else:
            out.append(line)
    return out + open_lines


@pytest.fixture()
def small_pieces(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "48")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_whole_reading(spark, tmp_dir, small_pieces, seed):
    rng = random.Random(seed)
    want = collections.Counter()
    for name in "abc":
        lines = []
        for i in range(60):
            kind = rng.random()
            body = ("x" * rng.randint(0, 30) if kind < 0.5 else '"' + "\n".join(["y" * rng.randint(0, 20)] * rng.randint(1, 9)) + '"'
                    if kind < 0.9 else '"é ""q""\n\nz"')
            lines.append(f"{i},{body},1.5")
        if name == "b":
            lines.append('7,"never closed,2\n8,x,2')
        text = (rng.choice(["\n", "\r\n"])).join(lines).replace("\r\n", "\n") + "\n"
        if name == "c":
            text = text.replace("\n", "\r\n")
        _write(tmp_dir, f"{name}.csv", text)
        want.update(_records(text, 120))
    got = whole_lines(spark, tmp_dir, 120)
    assert spark.read.text(tmp_dir).rdd.getNumPartitions() > 20
    assert collections.Counter(r.line for r in got.collect()) == want


def test_scan_equals_a_multi_line_read(spark, tmp_dir, small_pieces):
    body = "".join(f'{i},"note {i}\n\n""said""\nend",{i}.5\n' if i % 3 else f"{i},plain,{i}.5\n" for i in range(80))
    _write(tmp_dir, "x.csv", "a,b,c\n" + body)
    records, rejected = scan_csv(spark, tmp_dir, SCHEMA, join_breaks=True)
    whole = (spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("escape", '"').csv(tmp_dir))
    assert sorted(map(tuple, records.collect())) == sorted(map(tuple, whole.collect()))
    assert rejected.count() == 0


def test_header_and_blank_lines_inside_a_record_are_its_own(spark, tmp_dir):
    _write(tmp_dir, "x.csv", 'a,b,c\n1,"p\n\na,b,c\nq",2\n\n2,r,3\n3,"open,4\n')
    records, rejected = scan_csv(spark, tmp_dir, SCHEMA, join_breaks=True)
    assert sorted(map(tuple, records.collect())) == [(1, "p\n\na,b,c\nq", 2.0), (2, "r", 3.0)]
    assert sorted(map(tuple, rejected.collect())) == [("", "blank"), ('3,"open,4', "open_quote")]


def test_a_record_too_long_is_undone(spark, tmp_dir):
    from stratus.sources import records as module
    text = '1,"a\nb",1\n2,"' + "c\n" * 40 + 'd",1\n3,x,1\n'
    _write(tmp_dir, "x.csv", text)
    got = collections.Counter(r.line for r in module.whole_lines(spark, tmp_dir, 50).collect())
    assert got == collections.Counter(_records(text, 50)) and got['1,"a\nb",1'] == 1 and got["c"] == 39


def test_empty_files(spark, tmp_dir):
    _write(tmp_dir, "x.csv", "")
    assert whole_lines(spark, tmp_dir).collect() == []


def test_pieces_without_breaks_are_not_put_in_order(spark, tmp_dir):
    _write(tmp_dir, "x.csv", "a,b,c\n" + "1,x,2\n" * 50)
    plan = whole_lines(spark, tmp_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 1
    first = plan.split("Union", 1)[1].split("Project", 2)
    assert "Window" not in "".join(first[:2])


def test_lines_are_joined_where_they_are_read(spark, tmp_dir, monkeypatch):
    _write(tmp_dir, "a.csv", "".join(f'{i},"x\ny",1.5\n' for i in range(500)))
    plans, write = {}, records.sinks.write_parquet

    def kept(df, path, **options):
        plans[os.path.basename(path).rsplit("-", 1)[0]] = plan_text(df)
        return write(df, path, **options)
    monkeypatch.setattr(records.sinks, "write_parquet", kept)
    assert sorted(r["line"] for r in whole_lines(spark, tmp_dir).collect()) == sorted(f'{i},"x\ny",1.5' for i in range(500))
    assert "MapInArrow" in plans["text-records"]
    assert not any(move in plans["text-records"] for move in ("Window", "hashpartitioning", "rangepartitioning"))


@pytest.mark.parametrize("limit", [40, 100_000])
def test_record_over_many_pieces(spark, tmp_dir, small_pieces, limit):
    text = '1,a,1.0\n2,"' + "\n".join(f"line {i}" for i in range(90)) + '",2.0\n3,"b\n\n",3.0\n' + '4,"open,4.0\n\nrest\n' * 2 + '5,"open\n'
    _write(tmp_dir, "a.csv", text)
    got = collections.Counter(r["line"] for r in whole_lines(spark, tmp_dir, limit).collect())
    assert got == collections.Counter(_records(text, limit))
