"""Shuffle and scan volume per catalog key, from Spark's event log.

Usage: python tools/shuffle_stats.py sf_dir key[,key...]

Runs each key once into the no-op sink with the event log written to a fresh
scratch folder, then sums the task metrics of that key's jobs: shuffle bytes
written, records written, task count, and per stage (id, tasks, ms). Deterministic, unlike
wall-clock time, so it shows what a plan change does to the data moved.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratus.plans import catalog  # noqa: E402
from stratus.session import build_session  # noqa: E402


def main():
    sf_dir, keys = sys.argv[1], sys.argv[2].split(",")
    log_dir = tempfile.mkdtemp(prefix="stratus-eventlog-")
    spark = build_session(master="local[4]", shuffle_partitions=8,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false",
                                 "spark.eventLog.rolling.enabled": "false"})
    sc = spark.sparkContext
    for i in range(2):  # JVM and code generation warm-up, not counted
        catalog.QUERIES["daily_features"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for key in keys:
        sc.setJobGroup(key, key)
        catalog.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("", "")
    spark.stop()
    stage_key, stats = {}, {k: {"shuffle_bytes": 0, "shuffle_records": 0,
                                "tasks": 0, "stages": []}  for k in keys}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_key[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    key = stage_key.get(info["Stage ID"])
                    if key in stats and "Completion Time" in info:
                        stats[key]["stages"].append(
                            (info["Stage ID"], info["Number of Tasks"],
                             info["Completion Time"] - info["Submission Time"]))
                elif kind == "SparkListenerTaskEnd":
                    key = stage_key.get(ev["Stage ID"])
                    m = ev.get("Task Metrics") or {}
                    if key in stats:
                        w = m.get("Shuffle Write Metrics", {})
                        stats[key]["shuffle_bytes"] += w.get("Shuffle Bytes Written", 0)
                        stats[key]["shuffle_records"] += w.get("Shuffle Records Written", 0)
                        stats[key]["tasks"] += 1
    for key in keys:
        print(json.dumps({"key": key, **stats[key]}))


if __name__ == "__main__":
    main()
