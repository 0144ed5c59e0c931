"""Frame profiles and run summaries as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.operators.quality import _inline


def column_profile(df: DataFrame) -> DataFrame:
    """ordinal, column_name, data_type, nullable, total_rows, null_count:
    the extraction metadata of a frame, from one scan."""
    row = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return _inline(row, [
        F.struct(F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.lit(f.nullable).alias("nullable"), F.col("total_rows").alias("total_rows"),
                 F.col(f"n{i}").alias("null_count"))
        for i, f in enumerate(df.schema.fields)])


def describe_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column_name, n, mean, stddev, min, max for numeric columns (as double).

    The same statistics as ``DataFrame.describe`` but typed, from one scan.
    """
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"),
                 F.stddev_samp(v).alias(f"sd{i}"), F.min(v).alias(f"min{i}"),
                 F.max(v).alias(f"max{i}")]
    row = df.agg(*aggs)
    return _inline(row, [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"),
                 F.col(f"mean{i}").alias("mean"), F.col(f"sd{i}").alias("stddev"),
                 F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"))
        for i, c in enumerate(cols)])


def transform_summary(daily: DataFrame, n_in: int, n_out: int, *, staged: DataFrame) -> DataFrame:
    """original_rows, transformed_rows, rows_removed, original_columns,
    transformed_columns, columns_added, from the frames one pass holds.

    ``staged``: (row, copies) of the input, see :func:`staged_rows`; ``daily``:
    the daily frame made of it, one row per transformed row.
    """
    row = _counts(staged, daily)
    return row.select(
        F.col("extraction_rows").alias("original_rows"), F.col("final_rows").alias("transformed_rows"),
        (F.col("extraction_rows") - F.col("final_rows")).alias("rows_removed"),
        F.lit(n_in).alias("original_columns"), F.lit(n_out).alias("transformed_columns"),
        F.lit(n_out - n_in).alias("columns_added"))


def _counts(staged: DataFrame, daily: DataFrame) -> DataFrame:
    """extraction_rows, cleaned_rows, final_rows: the sum of the copies, the sum
    of the daily rows' n_rows, and the number of daily rows."""
    z = F.lit(0).cast("long")
    both = staged.select(F.col("copies").alias("e"), z.alias("c"), z.alias("f")).unionByName(
        daily.select(z.alias("e"), F.col("n_rows").alias("c"), F.lit(1).cast("long").alias("f")))
    return both.agg(*[F.coalesce(F.sum(a), z).alias(n) for a, n in (
        ("e", "extraction_rows"), ("c", "cleaned_rows"), ("f", "final_rows"))])


def pipeline_summary(staged: DataFrame, daily: DataFrame) -> DataFrame:
    """extraction_rows, cleaned_rows, final_rows, status (derived from the data:
    SUCCESS when the job produced rows, EMPTY otherwise)."""
    row = _counts(staged, daily)
    return row.select("extraction_rows", "cleaned_rows", "final_rows",
                      F.when(F.col("final_rows") > 0, F.lit("SUCCESS"))
                       .otherwise(F.lit("EMPTY")).alias("status"))
