import datetime as dt
import math
import re

from pyspark.sql import functions as F

from stratus.operators import quality
from stratus.operators.clean import clean_readings
from stratus.operators.report import quality_report
from stratus.plans.inspect import plan_text
from stratus.profile import READINGS
from stratus.sources.contract import STANDARD_CONTRACT
from stratus.sources.readings import readings
from tests.fixtures import READING_SCHEMA, reading

TS = dt.datetime(2020, 1, 1)


def test_empty_frame(spark):
    df = spark.createDataFrame([], READING_SCHEMA)
    comp = quality.completeness(df).collect()
    assert all(r.completeness_pct == 100.0 and not r.null_breach for r in comp)
    dup = quality.duplicates(df).collect()[0]
    assert (dup.total_rows, dup.duplicate_pct, dup.valid) == (0, 0.0, True)
    long = quality.full_validation(df, READINGS, STANDARD_CONTRACT, as_of="2030-01-01 00:00:00")
    summary = quality.validation_summary(long).collect()[0]
    assert summary.overall_valid and summary.total_validations == 5


def test_boundaries_nan_and_nulls(spark):
    rows = [reading(1, TS, temp=-50.0, hum=0.0, wind=0.0, pressure=800.0),
            reading(2, TS, temp=60.0, hum=1.0, wind=200.0, pressure=1100.0),
            reading(3, TS, temp=None, hum=None, wind=None, pressure=None),
            reading(4, TS, temp=float("nan"))]
    df = spark.createDataFrame(rows, READING_SCHEMA)
    v = {r.field: r for r in quality.range_violations(df).collect()}
    assert v["temperatureC"].max_violations == 1 and v["temperatureC"].min_violations == 0
    for f in ("humidity", "wind_speed_kmh", "pressure_millibars"):
        assert v[f].valid


def test_completeness_breach_strict(spark):
    rows = [reading(i, TS, temp=None if i == 0 else 1.0, summary="" if i < 2 else "s")
            for i in range(10)]
    comp = {r.column_name: r for r in quality.completeness(spark.createDataFrame(rows, READING_SCHEMA)).collect()}
    assert comp["temperatureC"].null_count == 1 and not comp["temperatureC"].null_breach  # 10% is not > 10%
    assert comp["summary"].empty_count == 2 and comp["summary"].empty_breach
    assert comp["reading_id"].empty_count is None


def test_temporal_strings(spark):
    df = spark.createDataFrame(
        [("2006-04-01 00:00:00.000 +0200",), ("garbage",), (None,), ("2031-01-01 00:00:00.000 +0000",)],
        "`Formatted Date` string")
    r = quality.temporal_check(df, "Formatted Date", "2030-01-01 00:00:00").collect()[0]
    assert (r.total_rows, r.invalid_dates, r.future_dates, r.valid) == (4, 2, 1, False)


def test_temporal_gaps(spark):
    days = [dt.date(2019, 12, 30), dt.date(2020, 1, 3), dt.date(2020, 1, 4), dt.date(2020, 1, 10)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    gaps = sorted(tuple(r) for r in quality.temporal_gaps(df, "d").collect())
    assert gaps == [(dt.date(2019, 12, 31), dt.date(2020, 1, 2), 3),
                    (dt.date(2020, 1, 5), dt.date(2020, 1, 9), 5)]


def test_quarantine_partitions_input(spark):
    r = readings(spark, "/root/testdata/sf0.001")
    by_reason = {x.reason: x.n for x in quality.quarantine_rows(r).groupBy("reason").agg(F.sum("copies").alias("n")).collect()}
    assert sum(by_reason.values()) + clean_readings(r).count() == r.count()
    assert by_reason["duplicate"] == r.count() - r.distinct().count()


def test_quarantine_keeps_copies_as_a_number(spark):
    rows = [reading(1, TS)] * 23 + [reading(2, TS, pressure=0.0)] * 3 + [reading(3, None)]
    df = spark.createDataFrame(rows, READING_SCHEMA)
    got = sorted((r.reading_id, r.reason, r.copies) for r in quality.quarantine_rows(df).collect())
    assert got == [(1, "duplicate", 22), (2, "duplicate", 2), (2, "invalid_pressure", 1), (3, "null_critical", 1)]


def test_stage_metrics_consistent(spark):
    r = readings(spark, "/root/testdata/sf0.001")
    stages = {s.stage: s for s in quality.stage_quality_metrics(r).collect()}
    assert stages["raw"].total_rows == r.count()
    assert stages["deduplicated"].total_rows == r.distinct().count()
    assert stages["cleaned"].total_rows == clean_readings(r).count()
    assert math.isclose(stages["cleaned"].valid_pct, 100.0)


def test_full_validation_matches_single_checks(spark):
    r = readings(spark, "/root/testdata/sf0.001")
    long = {(x.check_name, x.field, x.metric): x
            for x in quality.full_validation(r, READINGS, STANDARD_CONTRACT, "2000-01-01 00:00:00").collect()}
    nulls = {x.column_name: x.null_count for x in quality.null_counts(r).collect()}
    total = r.count()
    assert math.isclose(long[("completeness", "temperatureC", "null_pct")].metric_value,
                        100.0 * nulls["temperatureC"] / total)
    dup = quality.duplicates(r).collect()[0]
    assert math.isclose(long[("duplicates", "*", "duplicate_pct")].metric_value, dup.duplicate_pct)
    assert long[("schema", "*", "issues")].valid


def test_report_lines(spark):
    r = readings(spark, "/root/testdata/sf0.001")
    lines = [x.line for x in quality_report(r, READINGS, None, "2000-01-01 00:00:00")
             .orderBy("line_no").collect()]
    assert lines[1] == "DATA QUALITY REPORT"
    assert lines[4].startswith("Validations Passed: ") and lines[4].endswith("/4")
    assert any(x.startswith("  temperatureC: ") and x.endswith("% complete") for x in lines)
    assert lines[-1] == "Report as of: 2000-01-01 00:00:00"


def test_one_shuffle_for_full_validation(spark):
    r = readings(spark, "/root/testdata/sf0.001")
    long = quality.full_validation(r, READINGS, STANDARD_CONTRACT, "2000-01-01 00:00:00")
    plan = plan_text(long)
    assert plan.count("HashAggregate") >= 4  # scan + duplicate aggregates, partial and final
    assert long.where(~F.col("valid")).count() > 0


def test_metrics_from_multiplicity_equal_direct(spark):
    """Whole-row key: metrics derived from (row, multiplicity) after the
    group-by must equal the same metrics aggregated row by row (reading_id
    as the key keeps every other column's metrics inside the group-by)."""
    rows = ([reading(1, TS, temp=-60.0, summary="")] * 4 + [reading(2, None, temp=None)] * 3
            + [reading(3, TS, temp=float("nan"), pressure=None)] * 2
            + [reading(4, dt.datetime(2031, 1, 1), hum=2.0, wind=250.0, pressure=700.0)]
            + [reading(5, TS, summary=None)])
    df = spark.createDataFrame(rows, READING_SCHEMA)
    as_of = "2030-01-01 00:00:00"

    def metrics(key_columns):
        return {(x.check_name, x.field, x.metric): (x.metric_value, x.valid)
                for x in quality.full_validation(df, READINGS, None, as_of, key_columns).collect()
                if x.check_name != "duplicates"}
    by_row, by_id = metrics(None), metrics(["reading_id"])
    assert by_row == by_id
    assert by_row[("temporal", "formatted_date", "future_dates")] == (1.0, False)
    assert by_row[("ranges", "temperatureC", "above_max")] == (2.0, False)  # NaN counts above


def test_whole_row_shuffle_carries_only_a_count(spark):
    r = readings(spark, "/root/testdata/sf0.001")
    plan = plan_text(quality.full_validation(r, READINGS, STANDARD_CONTRACT, "2000-01-01 00:00:00"))
    # The aggregates keyed on the whole row compute the multiplicity only.
    keyed = [sec for sec in plan.split("\n\n")
             if re.match(r"\(\d+\) HashAggregate", sec) and "Keys [8]" in sec]
    assert len(keyed) == 2
    assert all(re.search(r"Functions \[1\]: \[(partial_)?count\(1\)\]", sec) for sec in keyed)


def test_grouping_companions_only_with_profile_key(spark):
    from stratus.profile import FEATURES
    rows = [(dt.date(2020, 1, 1), 2020, 1, "Winter"), (dt.date(2021, 1, 1), 2021, 1, "Winter")]
    df = spark.createDataFrame(rows, "date date, year int, month int, season string")
    by_season = quality.duplicates(df, ["season"], FEATURES).collect()[0]
    assert (by_season.unique_rows, by_season.duplicate_count) == (1, 1)
    plan = quality.QualityPlan(df, FEATURES)
    assert plan.group_columns == ["year", "month", "date"]
