import os
import re

import pytest

from pyspark.sql import functions as F

from stratus import sinks
from stratus.operators.clean import clean_readings
from stratus.operators.quality import QualityPlan
from stratus.plans import catalog
from stratus.plans.inspect import plan_summary, plan_text
from stratus.plans.pipeline import run_job
from stratus.profile import READINGS
from stratus.sources.readings import readings, table

SF = "/root/testdata/sf0.001"


def _above_first_exchange(plan: str, node: str) -> bool:
    """True when every ``node`` of the physical tree sits above its first
    Exchange, i.e. runs in the query's result stage."""
    tree = plan.split("\n\n")[0].splitlines()
    first_exchange = next((i for i, line in enumerate(tree) if "Exchange" in line), len(tree))
    where = [i for i, line in enumerate(tree) if node in line]
    return bool(where) and all(i < first_exchange for i in where)


def test_run_job_summary_from_result_stages(spark, tmp_dir):
    r = readings(spark, SF)
    with pytest.warns(UserWarning, match="quality check rows failed"):
        job = run_job(spark, r, os.path.join(tmp_dir, "job"), as_of="2000-01-01 00:00:00")
    assert job.failed_checks > 0 and job.rejected_path is None
    s = job.summary.collect()[0]
    features = catalog.features(spark, SF)
    assert (s.extraction_rows, s.cleaned_rows, s.final_rows, s.status) == (
        r.count(), clean_readings(r).count(), features.count(), "SUCCESS")
    assert job.verification.collect()[0].valid
    assert spark.read.json(job.raw_quality_path).count() > 0
    assert spark.read.json(job.feature_quality_path).count() > 0
    assert [tuple(x) for x in job.loads.select("format", "n_rows", "n_columns").collect()] == [("parquet", s.final_rows, 24)]
    assert {x.total_rows for x in job.extraction.collect()} == {r.count()}


def test_run_job_from_csv_in_a_zone(spark, tmp_dir):
    from tests.fixtures import write_f1
    path = os.path.join(tmp_dir, "weather.csv")
    write_f1(path, copies=3)
    for zone, day in (("Europe/Budapest", 15), ("UTC", 14)):
        with pytest.warns(UserWarning):
            job = run_job(spark, path, os.path.join(tmp_dir, zone[:3]), zone=zone, formats=("parquet", "xml"))
        rows = sinks.read_back(spark, job.outputs["parquet"]).collect()
        assert [r.date.day for r in rows] == [day] and rows[0].n_rows == 2
        assert tuple(job.summary.first())[:3] == (6, 2, 1)


def test_run_job_rejects_unknown_formats_first(spark, tmp_dir):
    with pytest.warns(UserWarning, match="xml"), pytest.raises(ValueError):
        run_job(spark, readings(spark, SF), os.path.join(tmp_dir, "x"), formats=("xml",))
    assert os.listdir(tmp_dir) == []


def test_few_gateway_calls_per_validation(spark):
    """Checks reach the JVM as text: far fewer calls than one per operator."""
    from py4j.java_gateway import JavaMember

    from stratus.operators.quality import full_validation
    r, calls, old = readings(spark, SF), [0], JavaMember.__call__

    def counted(self, *args):
        calls[0] += 1
        return old(self, *args)
    JavaMember.__call__ = counted
    try:
        full_validation(r, READINGS, None, "2000-01-01 00:00:00")
    finally:
        JavaMember.__call__ = old
    assert calls[0] < 600


def test_job_observations_run_in_result_stage(spark):
    plan = QualityPlan(readings(spark, SF), READINGS)
    from pyspark.sql import Observation
    wide = plan.wide().observe(Observation("t"), F.sum("total_rows").alias("rows"))
    assert _above_first_exchange(plan_text(plan.long(wide)), "CollectMetrics")
    observed, _ = sinks.files._observed(sinks.files._prepared(catalog.features(spark, SF), True),
                                        "t", {"n": F.sum("n_rows")})
    assert _above_first_exchange(plan_text(observed), "CollectMetrics")


def test_cluster_confs_at_scale():
    from stratus.session import cluster_confs
    big = cluster_confs(100 * 10 ** 12, executor_cores=8, executors=1000)
    n = int(big["spark.sql.shuffle.partitions"])
    assert n % 8000 == 0 and n * (1 << 30) >= 100 * 10 ** 12
    assert big["spark.sql.adaptive.enabled"] == "true"
    assert big["spark.sql.session.timeZone"] == "UTC"
    small = cluster_confs(10 ** 9, executor_cores=4, executors=2)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_lookup_join_is_left_to_the_planner(spark):
    from stratus.operators.joins import lookup_join
    facts, part = table(spark, SF, "lineitem"), table(spark, SF, "part")

    def joined():
        return lookup_join(facts, part, "l_partkey", "p_partkey", ["p_brand"]).groupBy("p_brand").count()
    rows = sorted(tuple(r) for r in joined().collect())
    assert "ResolvedHint" not in plan_text(joined(), "extended")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert plan_summary(joined())["broadcast_joins"] == 0
        assert sorted(tuple(r) for r in joined().collect()) == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_run_job_reject_policies(spark, tmp_dir):
    from stratus.operators.policy import QualityError
    from stratus.operators.quality import quarantine_rows
    from stratus.sources.contract import RAW_CONTRACT, STANDARD_CONTRACT
    r = readings(spark, SF)
    with pytest.raises(ValueError, match="schema check failed"):
        run_job(spark, r, os.path.join(tmp_dir, "a"), expected_schema=RAW_CONTRACT)
    with pytest.raises(QualityError):
        run_job(spark, r, os.path.join(tmp_dir, "b"), on_fail="raise")
    assert not os.path.exists(os.path.join(tmp_dir, "b", "features"))
    with pytest.warns(UserWarning):
        job = run_job(spark, r, os.path.join(tmp_dir, "c"), expected_schema=STANDARD_CONTRACT,
                      on_fail="quarantine")
    rejected = spark.read.parquet(job.rejected_path)
    assert rejected.count() == quarantine_rows(r).count()
    s = job.summary.collect()[0]
    assert s.cleaned_rows + sum(x.copies for x in rejected.collect()) == s.extraction_rows
