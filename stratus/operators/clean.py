"""Cleaning: column standardising, exact de-duplication, critical-null drop,
invalid-reading filter, and their composite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions.exprs import resolve
from stratus.profile import READINGS, Profile


def standardize_columns(df: DataFrame, profile: Profile = READINGS) -> DataFrame:
    """Rename every known raw column that is present (matched case-insensitively)
    to its standard name. Metadata only: no data is touched."""
    mapping = {}
    for raw, standard in profile.rename_map.items():
        actual = resolve(df, raw)
        if actual is not None and actual != standard:
            mapping[actual] = standard
    return df.withColumnsRenamed(mapping) if mapping else df


def dedup_exact(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop exact duplicate rows (or rows equal on ``subset``).

    Planned as a hash aggregate on the row: map-side partial aggregation
    collapses copies before the shuffle, so one hot row never reaches a reducer
    more than once per map task.
    """
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def staged_rows(df: DataFrame) -> DataFrame:
    """Distinct rows with ``copies``, the number of times each stands in ``df``:
    one whole-row shuffle from which counts, rejects and cleaned rows follow."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("copies"))


def _present(df: DataFrame, names) -> list[str]:
    return [c for c in (resolve(df, n) for n in names) if c is not None]


def drop_critical_nulls(df: DataFrame, profile: Profile = READINGS) -> DataFrame:
    """Drop rows with a null in any critical column that is present.

    Only null counts: a NaN reading is a value and stays (``dropna`` would
    drop NaN too, so the rule is written as an explicit filter).
    """
    cols = _present(df, profile.critical_columns)
    if not cols:
        return df
    keep = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        keep = keep & F.col(c).isNotNull()
    return df.filter(keep)


def invalid_condition(df: DataFrame, profile: Profile = READINGS,
                      null_policy: str | None = None) -> Column | None:
    """True where the pressure reading is invalid (<= 0 or below the minimum).

    Null pressure is invalid under ``null_policy="drop"`` and valid under
    ``"keep"``. None when the frame has no pressure column.
    """
    name = resolve(df, profile.pressure_column)
    if name is None:
        return None
    policy = null_policy or profile.null_policy
    if policy not in ("drop", "keep"):
        raise ValueError(f"null_policy must be 'drop' or 'keep', got {policy!r}")
    p = F.col(name)
    ok = (p > 0) & (p >= F.lit(profile.pressure_min))
    if policy == "keep":
        ok = ok | p.isNull()
    return ~F.coalesce(ok, F.lit(False))


def filter_invalid(df: DataFrame, profile: Profile = READINGS,
                   null_policy: str | None = None) -> DataFrame:
    """Keep only rows whose pressure reading is valid (see invalid_condition)."""
    cond = invalid_condition(df, profile, null_policy)
    return df if cond is None else df.filter(~cond)


def clean_readings(df: DataFrame, profile: Profile = READINGS, remove_duplicates: bool = True,
                   handle_nulls: bool = True, standardize: bool = True,
                   null_policy: str | None = None) -> DataFrame:
    """Composite cleaning: standardise -> de-duplicate -> critical nulls -> invalid.

    Renaming is metadata, so doing it first changes no row. The row filters
    reference only grouping columns of the de-duplication aggregate, so
    Catalyst pushes them below it and into the scan.
    """
    out = standardize_columns(df, profile) if standardize else df
    if remove_duplicates:
        out = dedup_exact(out)
    if handle_nulls:
        out = drop_critical_nulls(out, profile)
    return filter_invalid(out, profile, null_policy)
