"""Lookup joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                dim_columns: list[str], how: str = "inner") -> DataFrame:
    """Attach ``dim_columns`` of ``dim`` to ``facts`` on fact_key = dim_key.

    Only the key and the asked columns of ``dim`` take part. How the join runs
    is the planner's choice: a broadcast where the measured size of that side
    is under spark.sql.autoBroadcastJoinThreshold, else a shuffle whose skewed
    partitions AQE splits.
    """
    small = dim.select(F.col(dim_key), *[F.col(c) for c in dim_columns])
    return facts.join(small, facts[fact_key] == small[dim_key], how).drop(small[dim_key])
