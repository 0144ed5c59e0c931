import re

from stratus.plans import catalog
from stratus.plans.inspect import plan_summary, plan_text

SF = "/root/testdata/sf0.001"


def test_features_one_window_stage(spark):
    text = plan_text(catalog.features(spark, SF))
    # dedup (whole row), daily (date), window (year, month): nothing else.
    assert len(re.findall(r"Arguments: hashpartitioning", text)) == 3
    assert len(re.findall(r"Arguments: hashpartitioning\(year#\d+, month#\d+", text)) == 1
    assert plan_summary(catalog.features(spark, SF))["windows"] == 1


def test_no_python_in_any_plan(spark):
    for key in ("daily_features", "full_validation", "quarantine_rows", "lookup_join",
                "seasonal_stats", "stage_quality_metrics"):
        assert plan_summary(catalog.QUERIES[key](spark, SF))["python_udfs"] == 0, key


def test_scan_pushdown_and_pruning(spark):
    text = plan_text(catalog.QUERIES["parquet_scan"](spark, SF))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts", text)
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(f.split(":")[0] for f in read_schema.split(",")) == ["event_type", "ts", "value"]


def test_readings_scan_prunes_lineitem(spark):
    text = plan_text(catalog.daily(spark, SF))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text):
        names = {f.split(":")[0] for f in schema.split(",")}
        assert "l_partkey" not in names and "l_suppkey" not in names


def test_lookup_join_broadcasts_small_dimension(spark):
    s = plan_summary(catalog.QUERIES["lookup_join"](spark, SF))
    assert s["broadcast_joins"] == 1 and s["sort_merge_joins"] == 0


def test_full_validation_single_plan(spark):
    df = catalog.QUERIES["full_validation"](spark, SF)
    text = plan_text(df)
    # One duplicate shuffle on the row, the rest are one-row gathers.
    assert len(re.findall(r"Arguments: hashpartitioning", text)) == 1


def test_feature_validation_reuses_window_partitioning(spark):
    text = plan_text(catalog.QUERIES["feature_validation"](spark, SF))
    # dedup (row), daily (date), window (year, month); the per-date duplicate
    # group-by runs on the window's partitioning, no exchange of its own.
    hashed = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", text)
    assert len(hashed) == 3
    assert plan_summary(catalog.QUERIES["feature_validation"](spark, SF))["exchanges"] == 4
