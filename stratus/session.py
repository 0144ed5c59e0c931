"""Session helpers: building a session for tests/bench and finding the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Confs the operators rely on. The zone is pinned so that to_date() on an
# instant is reproducible; ANSI stays on (Spark 4 default) and the operators
# use try_* functions wherever a bad value must count instead of raise.
REQUIRED_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "stratus", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (no UI, pinned zone, AQE on)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for key, value in {**REQUIRED_CONFS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Sizing of a large run.
SCAN_SPLIT_BYTES = 512 << 20          # bytes of input per scan task
SHUFFLE_TARGET_BYTES = 1 << 30        # initial shuffle bytes per reducer
ADVISORY_PARTITION_BYTES = 256 << 20  # AQE target after coalescing/splitting


def cluster_confs(input_bytes: int, executor_cores: int, executors: int) -> dict[str, str]:
    """Shuffle/scan sizing for a large run.

    Map tasks read ``SCAN_SPLIT_BYTES`` each, so 100 TB is about 200k tasks
    rather than 800k. The initial reducer count gives each reducer about
    ``SHUFFLE_TARGET_BYTES`` of a shuffle as large as the input (a whole-row
    de-duplication), rounded up to whole waves of the cluster's task slots.
    AQE then coalesces small partitions to the advisory size, honouring it over
    default parallelism, and splits skewed ones.
    """
    slots = max(1, executor_cores * executors)
    wanted = max(slots * 2, -(-input_bytes // SHUFFLE_TARGET_BYTES))
    partitions = -(-wanted // slots) * slots
    return {
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.files.maxPartitionBytes": str(SCAN_SPLIT_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(ADVISORY_PARTITION_BYTES),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        **REQUIRED_CONFS,
    }


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` as set on the session (the
    cluster names a shared filesystem there), else from the context's own
    checkpoint folder. A session that names neither gets a local folder only
    when it runs in local mode, where driver and executors are one process; on
    a cluster that would be a machine-local folder, so it is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="stratus-ckpt-")
        context.setCheckpointDir(base)
    return os.path.join(base.rstrip("/"), "stratus", f"{name}-{uuid.uuid4().hex[:12]}")
