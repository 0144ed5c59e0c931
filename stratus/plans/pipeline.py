"""The full job: source -> clean -> daily -> features -> verified sinks, with
the quality results, the rejects and the summaries stored beside the output.

The distinct rows of the input with their copies are staged once in the shared
folder: the one whole-row shuffle of the job. Validation, rejects, extraction
metadata and cleaning read that stage. Counters are ``Observation``s in the
result stages of writes; every write is checked against what it observed.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus import sinks
from stratus.operators.clean import clean_readings, staged_rows, standardize_columns
from stratus.operators.daily import daily_agg
from stratus.operators.features import daily_features
from stratus.operators.policy import QualityError
from stratus.operators.profiling import column_profile
from stratus.operators.quality import QualityPlan, full_validation, quarantine_rows, schema_issues
from stratus.profile import FEATURES, READINGS, Profile
from stratus.session import shared_dir
from stratus.sources.files import read_csv


@dataclass
class JobResult:
    """``summary``: extraction_rows, cleaned_rows, final_rows, status. ``loads``:
    what each format holds (sinks.load_summary). ``extraction``: the input's
    columns (profiling.column_profile). Both are read when asked for."""

    outputs: dict
    summary: DataFrame
    verification: DataFrame
    raw_quality_path: str
    feature_quality_path: str
    loads: DataFrame
    extraction: DataFrame
    failed_checks: int = 0
    rejected_path: str | None = None


SUMMARY_SCHEMA = T.StructType([
    T.StructField("extraction_rows", T.LongType()),
    T.StructField("cleaned_rows", T.LongType()),
    T.StructField("final_rows", T.LongType()),
    T.StructField("status", T.StringType()),
])


def run_job(spark: SparkSession, source: DataFrame | str, out_dir: str,
            profile: Profile = READINGS, as_of: str | None = None,
            formats: tuple[str, ...] = ("parquet",),
            expected_schema: T.StructType | None = None, on_fail: str = "warn",
            series_keys: tuple[str, ...] = (), zone: str | None = None) -> JobResult:
    """Validate the input, then clean -> daily -> features -> verified sinks.

    ``source`` is a frame of readings, or the path of raw CSV files, which are
    read under the raw contract and standardised. Days of instants are those of
    ``zone``; ``series_keys`` keep several series apart.

    An unsupported format alone, a missing contract field or a type mismatch in
    ``expected_schema`` raises ValueError before any job runs. A failed quality
    check then, by ``on_fail``: ``"warn"`` warns and continues; ``"raise"``
    raises QualityError before the features are built; ``"quarantine"``
    continues and also writes the rejected rows, each with its reason and number
    of copies, to ``<out_dir>/rejected`` (dead letter). A write whose files do
    not hold what was written raises VerificationError.
    """
    if on_fail not in ("warn", "raise", "quarantine"):
        raise ValueError(f"on_fail must be 'warn', 'raise' or 'quarantine', got {on_fail!r}")
    formats = tuple(sinks.known_formats(formats))
    readings = standardize_columns(read_csv(spark, source), profile) if isinstance(source, str) else source
    if expected_schema is not None:
        bad = [i for i in schema_issues(readings.schema, expected_schema) if i[1] != "extra"]
        if bad:
            raise ValueError(f"schema check failed: {bad}")
    out_dir = out_dir.rstrip("/")
    raw_quality_path = f"{out_dir}/quality/raw"
    rows = sinks.write_parquet(staged_rows(readings), shared_dir(spark, "job-rows"), verify=False,
                               metrics={"rows": F.sum("copies")})
    staged = sinks.read_back(spark, rows)
    plan = QualityPlan(readings, profile, expected_schema, as_of, staged=staged)
    raw_quality = sinks.write_json(
        plan.long(plan.wide()), raw_quality_path, rebalance=False,
        metrics={"failed": F.count_if(~F.coalesce(F.col("valid"), F.lit(False)))})
    failed = int(raw_quality.metrics["failed"] or 0)
    if failed:
        message = f"{failed} quality check rows failed on the input (see {raw_quality_path})"
        if on_fail == "raise":
            raise QualityError(message)
        warnings.warn(message, stacklevel=2)

    rejected_path = None
    if on_fail == "quarantine":
        rejected_path = f"{out_dir}/rejected"
        sinks.write_parquet(quarantine_rows(readings, profile, staged), rejected_path)

    cleaned = clean_readings(staged.drop("copies"), profile, remove_duplicates=False)
    features = daily_features(daily_agg(cleaned, profile, series_keys=series_keys, zone=zone),
                              series_keys=series_keys)
    # Every cleaned row lands in exactly one daily row (a null date is a group
    # too), so sum(n_rows) observed on the feature write is the cleaned count.
    outputs = sinks.write_multiple_formats(features, f"{out_dir}/features", formats,
                                           metrics={"cleaned_rows": F.sum("n_rows")})
    first = outputs[formats[0]]

    feature_quality_path = f"{out_dir}/quality/features"
    written = sinks.read_back(spark, first)
    checked = FEATURES.with_(duplicate_keys=(*series_keys, *FEATURES.duplicate_keys))
    sinks.write_json(full_validation(written, checked, None, as_of), feature_quality_path,
                     rebalance=False)

    final_rows = first.expected_rows
    summary = spark.createDataFrame(
        [(int(rows.metrics["rows"] or 0), int(first.metrics["cleaned_rows"] or 0), final_rows,
          "SUCCESS" if final_rows > 0 else "EMPTY")], SUMMARY_SCHEMA)
    return JobResult(outputs, summary, first.verification(spark), raw_quality_path,
                     feature_quality_path, sinks.load_summary(spark, outputs),
                     column_profile(readings), failed, rejected_path)
