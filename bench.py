"""Benchmark: headline catalog keys at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each key: one warm-up run, then the median of $BENCH_RUNS timed runs. A run
builds the query and executes it fully into Spark's no-op sink (nothing is
collected). Also reported per key: Spark jobs per run and shuffle exchanges
in the plan. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratus.plans import catalog  # noqa: E402
from stratus.plans.inspect import plan_summary  # noqa: E402
from stratus.plans.pipeline import run_job  # noqa: E402
from stratus.session import build_session, shared_dir  # noqa: E402
from stratus.sources.readings import readings  # noqa: E402

HEADLINE = [
    "daily_features", "clean_readings", "daily_agg", "full_validation", "quality_report",
    "feature_validation", "quarantine_rows", "stage_quality_metrics", "duplicates_full",
    "completeness", "temporal_gaps", "lookup_join", "parquet_roundtrip", "csv_scan",
    "incremental_equals_full", "stream_daily_agg", "seasonal_decomposition",
    "metric_correlation", "parquet_scan",
    "stream_features", "multi_format_counts", "pipeline_summary", "csv_glob_scan",
    "rank_correlation", "series_features", "dedup_across_batches", "compact_small_files", "publish_versions",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = [k for k in os.environ.get("BENCH_KEYS", ",".join(HEADLINE)).split(",") if k]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    sc = spark.sparkContext
    tracker = sc.statusTracker()

    def timed(key, fn):
        sc.setJobGroup(key, key)
        t0 = time.perf_counter()
        df = fn()
        if df is not None:
            df.write.format("noop").mode("overwrite").save()
        elapsed = time.perf_counter() - t0
        jobs = len(tracker.getJobIdsForGroup(key))
        sc.setJobGroup("", "")
        return elapsed, jobs, df

    # JVM/codegen warm-up on the flagship plan before anything is timed.
    for i in range(3):
        timed(f"jvm-warmup-{i}", lambda: catalog.QUERIES["daily_features"](spark, sf_dir))

    times, jobs, exchanges = {}, {}, {}
    for key in keys:
        fn = catalog.QUERIES[key]
        _, _, df = timed(f"{key}-warm", lambda: fn(spark, sf_dir))
        exchanges[key] = plan_summary(df)["exchanges"]
        samples = []
        for i in range(runs):
            t, j, _ = timed(f"{key}-{i}", lambda: fn(spark, sf_dir))
            samples.append(t)
            jobs[key] = j
        times[key] = round(statistics.median(samples), 3)

    def full_job():
        run_job(spark, readings(spark, sf_dir), shared_dir(spark, "bench_job"),
                as_of="2000-01-01 00:00:00")
        return None
    timed("full_job-warm", full_job)
    samples = []
    for i in range(runs):
        t, j, _ = timed(f"full_job-{i}", full_job)
        samples.append(t)
        jobs["full_job"] = j
    times["full_job"] = round(statistics.median(samples), 3)

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus), "runs": runs, "spark_jobs": jobs, "plan_exchanges": exchanges,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
