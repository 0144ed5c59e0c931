"""Helpers shared by the corpus operators.

Results that several later jobs read are written as Parquet under the shared
folder (:func:`stage`), which cuts the lineage: a lost executor costs only the
tasks of the running job.
"""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from stratus.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python workers, once per context."""
    context = spark.sparkContext
    if not getattr(context, "_stratus_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        folder = tempfile.mkdtemp(prefix="stratus-ship-")
        shutil.copytree(os.path.join(root, "stratus"), os.path.join(folder, "zip", "stratus"),
                        ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(os.path.join(folder, "stratus"), "zip",
                                              os.path.join(folder, "zip")))
        context._stratus_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return it as read back."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a few columns that may be broadcast: tens of MB.
MAX_BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame) -> DataFrame:
    """A staged table marked for broadcast if it is within MAX_BROADCAST_ROWS;
    beyond that the join is left to the planner, which shuffles both sides."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_ROWS else df


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts of ASCII alone take the faster ``lower``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
