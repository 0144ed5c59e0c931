"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from stratus.functions.exprs import (
    as_timestamp,
    count_where,
    is_weekend,
    pct,
    resolve,
    row_checksum,
    season,
)

__all__ = ["as_timestamp", "count_where", "is_weekend", "pct", "resolve", "row_checksum", "season"]
