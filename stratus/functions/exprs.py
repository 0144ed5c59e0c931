"""Reusable Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.profile import SEASON_OTHERWISE, SEASONS, WEEKEND_DAYS


def resolve(df: DataFrame, name: str) -> str | None:
    """Actual column name matching ``name`` case-insensitively, else None."""
    wanted = name.lower()
    for c in df.columns:
        if c.lower() == wanted:
            return c
    return None


def count_where(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (null counts as false)."""
    return F.count_if(cond)


def pct(part: Column, total: Column) -> Column:
    """``100 * part / total`` as double; 0 for an empty frame."""
    return F.when(total > 0, F.lit(100.0) * part / total).otherwise(F.lit(0.0))


def season(month: Column) -> Column:
    expr = None
    for name, months in SEASONS:
        expr = (F.when(month.isin(list(months)), F.lit(name)) if expr is None
                else expr.when(month.isin(list(months)), F.lit(name)))
    return expr.otherwise(F.lit(SEASON_OTHERWISE))


def is_weekend(date: Column) -> Column:
    return F.when(F.dayofweek(date).isin(list(WEEKEND_DAYS)), F.lit(1)).otherwise(F.lit(0))


def as_timestamp(df: DataFrame, column: str, fmt: str) -> Column:
    """The column as a timestamp: strings are parsed with ``fmt`` (unparseable
    text gives null instead of an ANSI error); timestamps pass through; dates
    are widened."""
    dtype = df.schema[column].dataType
    col = F.col(column)
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(col, F.lit(fmt))
    if isinstance(dtype, T.DateType):
        return col.cast("timestamp_ntz")
    return col


def row_checksum(columns: list[str]) -> Column:
    """Order-free checksum contribution of one row (summed by the caller).

    xxhash64 of all values, widened to decimal so that the sum cannot
    overflow under ANSI arithmetic.
    """
    return F.xxhash64(*[F.col(c) for c in columns]).cast("decimal(20,0)")


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns], F.lit(False))
