"""What to do with a frame that fails its quality checks."""

from __future__ import annotations

import warnings
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stratus.operators.clean import clean_readings
from stratus.operators.quality import (
    full_validation,
    quarantine_rows,
    schema_issues,
    validation_summary,
)
from stratus.profile import READINGS, Profile


class QualityError(ValueError):
    """Raised by ``apply_policy(on_fail="raise")`` when a check fails."""


def apply_policy(df: DataFrame, profile: Profile = READINGS, on_fail: str = "warn",
                 expected_schema: T.StructType | None = None,
                 as_of: str | datetime | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Returns (frame to continue with, rejected rows or None).

    A missing contract field or a type mismatch always raises ValueError
    (metadata only, no job). Then:
    - ``"raise"``: one validation query; QualityError if any check fails.
    - ``"warn"``: one validation query; a warning if any check fails, the
      frame continues unchanged.
    - ``"quarantine"``: no action; the cleaned frame continues and the
      rejected rows, each with its reason, are returned beside it.
    """
    if expected_schema is not None:
        bad = [i for i in schema_issues(df.schema, expected_schema) if i[1] != "extra"]
        if bad:
            raise ValueError(f"schema check failed: {bad}")
    if on_fail == "quarantine":
        return clean_readings(df, profile), quarantine_rows(df, profile)
    if on_fail not in ("raise", "warn"):
        raise ValueError(f"on_fail must be 'raise', 'warn' or 'quarantine', got {on_fail!r}")
    long = full_validation(df, profile, None, as_of)
    summary = validation_summary(long).first()
    if not summary["overall_valid"]:
        message = (f"{summary['failed_validations']} of {summary['total_validations']} "
                   f"quality checks failed")
        if on_fail == "raise":
            raise QualityError(message)
        warnings.warn(message, stacklevel=2)
    return df, None
