"""Human-readable quality report as a DataFrame of (line_no, line).

Every line is an expression over the one-row wide metrics frame of
``QualityPlan``; line numbers follow from the frame's schema, so the report
needs no ordering window and comes out of the same single job as the checks.
Percentages are formatted with integer arithmetic (round half up), so the
text does not depend on an engine's float formatting.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.operators.quality import QualityPlan, _inline
from stratus.profile import READINGS, Profile

# The texts of the report.
RULE = "=" * 60
THIN = "-" * 40
TITLE, OVERALL, COUNT, DETAILS = "DATA QUALITY REPORT", "Overall Status: ", "Validations Passed: ", "DETAILED RESULTS:"
PASSED, FAILED, NOT_AVAILABLE = "PASSED", "FAILED", "N/A"
ISSUES, TOTAL, COMPLETE, DUPLICATES = "  Issues: ", "  Total Rows: ", "% complete", "  Duplicate Percentage: "
DATES, INVALID, FUTURE, AS_OF = "  Date Range: ", "  Invalid Dates: ", ", Future Dates: ", "Report as of: "


def _pct_text(part: str, total: str, scale: int, empty: int) -> Column:
    unit = 10 ** scale
    q = (f"(CASE WHEN {total} > 0 THEN (200 * {unit} * ({part}) + {total}) div (2 * {total}) "
         f"ELSE {empty * unit} END)")
    return F.expr(f"concat(CAST({q} div {unit} AS STRING), '.', "
                  f"lpad(CAST({q} % {unit} AS STRING), {scale}, '0'))")


def _num6(col: str) -> Column:
    return F.coalesce(F.format_string("%.6f", F.col(col)), F.lit(NOT_AVAILABLE))


def quality_report(df: DataFrame, profile: Profile = READINGS,
                   expected_schema: T.StructType | None = None,
                   as_of: str | datetime | None = None,
                   key_columns: list[str] | None = None) -> DataFrame:
    plan = QualityPlan(df, profile, expected_schema, as_of, key_columns)
    valid = plan.check_valid()
    status = {k: F.when(v, F.lit(PASSED)).otherwise(F.lit(FAILED)) for k, v in valid.items()}
    overall = None
    passed = None
    for v in valid.values():
        overall = v if overall is None else overall & v
        one = F.when(v, F.lit(1)).otherwise(F.lit(0))
        passed = one if passed is None else passed + one
    lines: list[Column] = [
        F.lit(RULE), F.lit(TITLE), F.lit(RULE),
        F.concat(F.lit(OVERALL), F.when(overall, F.lit(PASSED)).otherwise(F.lit(FAILED))),
        F.concat(F.lit(COUNT), passed.cast("string"),
                 F.lit(f"/{len(plan.checks)}")),
        F.lit(""), F.lit(DETAILS), F.lit(THIN),
    ]
    for check in plan.checks:
        lines += [F.lit(""), F.concat(F.lit(f"{check.upper()}: "), status[check])]
        if check == "schema":
            n = len([i for i in plan.schema_issues() if i[1] != "extra"])
            lines.append(F.lit(f"{ISSUES}{n}"))
        elif check == "completeness":
            lines.append(F.concat(F.lit(TOTAL), F.format_number(F.col("total_rows"), 0)))
            for i, c in enumerate(plan.columns):
                lines.append(F.concat(F.lit(f"  {c}: "),
                                      _pct_text(f"total_rows - null_{i}", "total_rows", 1, 100),
                                      F.lit(COMPLETE)))
        elif check == "ranges":
            for j, (_, name) in enumerate(plan.rules):
                lines.append(F.concat(F.lit(f"  {name}: min="), _num6(f"min_{j}"),
                                      F.lit(", max="), _num6(f"max_{j}")))
        elif check == "duplicates":
            lines.append(F.concat(F.lit(DUPLICATES),
                                  _pct_text("dup_total - dup_unique", "dup_total", 2, 0),
                                  F.lit("%")))
        elif check == "temporal" and plan.date_column is not None:
            lines.append(F.concat(F.lit(DATES),
                                  F.coalesce(F.col("ts_min").cast("string"), F.lit(NOT_AVAILABLE)),
                                  F.lit(" to "),
                                  F.coalesce(F.col("ts_max").cast("string"), F.lit(NOT_AVAILABLE))))
            lines.append(F.concat(F.lit(INVALID), F.col("ts_invalid").cast("string"),
                                  F.lit(FUTURE), F.col("ts_future").cast("string")))
        elif check == "temporal":
            lines.append(F.lit(f"  Date column {profile.date_column} not found"))
    stamp = as_of if isinstance(as_of, str) or as_of is None else as_of.strftime("%Y-%m-%d %H:%M:%S")
    lines += [F.lit(""), F.lit(RULE), F.lit(f"{AS_OF}{stamp or 'unspecified'}")]
    structs = [F.struct(F.lit(n).alias("line_no"), line.alias("line"))
               for n, line in enumerate(lines, start=1)]
    return _inline(plan.wide(), structs)
