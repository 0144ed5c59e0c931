"""Registered queries: key -> (spark, sf_dir) -> DataFrame, and their oracles.

Every query reads the driver's tables (or frames Spark derives from them) in
full; nothing is capped, sampled or filtered to make the check cheaper.
Inexact floating outputs are rounded to 6 places in the final projection, the
same way in the oracle SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.operators import clean as clean_ops
from stratus.operators import daily as daily_ops
from stratus.operators import features as feature_ops
from stratus.operators import profiling as profiling_ops
from stratus.operators import quality as quality_ops
from stratus.operators import report as report_ops
from stratus import sinks, sources
from stratus import streaming
from stratus.operators import analytics as analytics_ops
from stratus.operators import joins as join_ops
from stratus.plans import daily_state, incremental
from stratus.plans import oracle as O
from stratus.plans.pipeline import run_job
from stratus.plans.seen_rows import SeenRows
from stratus.profile import FEATURES, READINGS, TIMESTAMP_FORMAT
from stratus.session import shared_dir
from stratus.sources.contract import RAW_CONTRACT, STANDARD_CONTRACT
from stratus.sources.readings import raw_readings, readings, table, text_readings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


def rounded(df: DataFrame, columns, places: int = 6) -> DataFrame:
    """Round the given columns in place (order kept)."""
    cols = set(columns)
    return df.select(*[F.round(F.col(c), places).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


DAILY_INEXACT = ("std_tempC",)
FEATURE_INEXACT = ("std_tempC", "temp_7d_avg", "temp_30d_avg", "temp_7d_std")


# -- frames shared by many keys ---------------------------------------------

def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_ops.clean_readings(readings(spark, sf_dir), READINGS)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_ops.daily_agg(cleaned(spark, sf_dir), READINGS)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_ops.daily_features(daily(spark, sf_dir))


# -- minimum slice -------------------------------------------------------------

@register("clean_readings", O.sql(f"SELECT {O.READINGS_COLUMNS} FROM C", "C"))
def q_clean_readings(spark, sf_dir):
    return cleaned(spark, sf_dir)


@register("daily_agg", O.sql(f"SELECT {O.DAILY_SELECT} FROM D", "D"))
def q_daily_agg(spark, sf_dir):
    return rounded(daily(spark, sf_dir), DAILY_INEXACT)


ZONES = ("Europe/Budapest", "America/New_York")


@register("daily_agg_zoned", O.union_rows([
    f"SELECT '{z}' AS zone, CAST(timezone('{z}', timezone('UTC', ts)) AS DATE) AS date, count(*) AS n_rows, "
    f"min(value) AS min_tempC, max(value) AS max_tempC FROM events GROUP BY ALL" for z in ZONES]))
def q_daily_agg_zoned(spark, sf_dir):
    # The events' times as instants (UTC), whatever the session zone is.
    instant = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    ev = table(spark, sf_dir, "events").withColumn("ts", instant)
    per_zone = [daily_ops.daily_agg(ev, READINGS, "value", "ts", zone=z).select(
        F.lit(z).alias("zone"), "date", "n_rows", "min_tempC", "max_tempC") for z in ZONES]
    return per_zone[0].unionByName(per_zone[1])


@register("daily_features_by_user", """
WITH D AS (SELECT user_id, CAST(ts AS DATE) AS date, count(*) AS n_rows, max(value) AS max_tempC, avg(value) AS avg_tempC
           FROM events GROUP BY user_id, CAST(ts AS DATE))
SELECT user_id, date, n_rows, max_tempC, round(avg_tempC, 6) AS avg_tempC, round(avg(avg_tempC) OVER w, 6) AS temp_7d_avg,
       round(max(avg_tempC) OVER w, 6) AS temp_7d_max, round(avg_tempC - lag(avg_tempC) OVER o, 6) AS temp_change_1d FROM D
WINDOW o AS (PARTITION BY user_id, year(date), month(date) ORDER BY date),
       w AS (PARTITION BY user_id, year(date), month(date) ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def q_daily_features_by_user(spark, sf_dir):
    d = daily_ops.daily_agg(table(spark, sf_dir, "events"), READINGS, "value", "ts", series_keys=("user_id",))
    out = feature_ops.daily_features(d, series_keys=("user_id",)).select(
        "user_id", "date", "n_rows", "max_tempC", "avg_tempC", "temp_7d_avg", "temp_7d_max", "temp_change_1d")
    return rounded(out, ("avg_tempC", "temp_7d_avg", "temp_7d_max", "temp_change_1d"))


@register("daily_features", O.sql(f"SELECT {O.FEATURES_SELECT} FROM F", "F"))
def q_daily_features(spark, sf_dir):
    return rounded(features(spark, sf_dir), FEATURE_INEXACT)



# -- split cleaning operators --------------------------------------------------

@register("standardize_columns", O.sql(f"SELECT {O.READINGS_COLUMNS} FROM R", "R"))
def q_standardize_columns(spark, sf_dir):
    return clean_ops.standardize_columns(raw_readings(spark, sf_dir), READINGS)


@register("dedup_exact", O.sql("SELECT DISTINCT * FROM R", "R"))
def q_dedup_exact(spark, sf_dir):
    return clean_ops.dedup_exact(readings(spark, sf_dir))


@register("drop_critical_nulls", O.sql(f"SELECT * FROM R WHERE {O.CRITICAL_OK}", "R"))
def q_drop_critical_nulls(spark, sf_dir):
    return clean_ops.drop_critical_nulls(readings(spark, sf_dir), READINGS)


@register("filter_invalid", O.sql(f"SELECT * FROM R WHERE {O.VALID_PRESSURE}", "R"))
def q_filter_invalid(spark, sf_dir):
    return clean_ops.filter_invalid(readings(spark, sf_dir), READINGS, null_policy="drop")


@register("filter_invalid_keep", O.sql(
    f"SELECT * FROM R WHERE pressure_millibars IS NULL OR {O.VALID_PRESSURE}", "R"))
def q_filter_invalid_keep(spark, sf_dir):
    return clean_ops.filter_invalid(readings(spark, sf_dir), READINGS, null_policy="keep")


# -- split feature operators ---------------------------------------------------

@register("calendar_features", O.sql(
    "SELECT date, year, month, day_of_week, quarter, is_weekend, season FROM F", "F"))
def q_calendar_features(spark, sf_dir):
    return feature_ops.calendar_features(daily(spark, sf_dir)).select(
        "date", "year", "month", "day_of_week", "quarter", "is_weekend", "season")


@register("rolling_features", O.sql(
    "SELECT date, round(temp_7d_avg, 6) AS temp_7d_avg, round(temp_30d_avg, 6) AS temp_30d_avg, "
    "round(temp_7d_std, 6) AS temp_7d_std, temp_7d_min, temp_7d_max FROM F", "F"))
def q_rolling_features(spark, sf_dir):
    out = feature_ops.rolling_features(daily(spark, sf_dir)).select(
        "date", *feature_ops.ROLLING_COLUMNS)
    return rounded(out, ("temp_7d_avg", "temp_30d_avg", "temp_7d_std"))


@register("lag_features", O.sql(
    "SELECT date, avg_tempC, temp_change_1d, temp_change_7d FROM F", "F"))
def q_lag_features(spark, sf_dir):
    return feature_ops.lag_features(daily(spark, sf_dir)).select(
        "date", "avg_tempC", *feature_ops.LAG_COLUMNS)


@register("preview_first_days", O.sql(
    "SELECT date, n_rows, avg_tempC FROM D ORDER BY date LIMIT 10", "D"))
def q_preview_first_days(spark, sf_dir):
    # A top-k preview: the limit is the feature (planned as TakeOrderedAndProject).
    return daily(spark, sf_dir).orderBy("date").limit(10).select("date", "n_rows", "avg_tempC")


# -- quality -----------------------------------------------------------------

READINGS_AS_OF = "2000-01-01 00:00:00"
EVENTS_AS_OF = "2024-01-20 00:00:00"

_R_QUALITY = O.QualitySQL("R", O.R_COLS, O.R_RULES, date_col="formatted_date",
                          as_of=READINGS_AS_OF, schema_rows=[])
_F_QUALITY = O.QualitySQL("F", O.F_COLS, O.F_RULES, keys=["date"], date_col="date",
                          as_of=READINGS_AS_OF, exempt=O.F_EXEMPT)


@register("null_counts", O.sql(O.union_rows([
    f"SELECT {O.lit(c)} AS column_name, count(*) FILTER (WHERE {O.q(c)} IS NULL) AS null_count FROM R"
    for c, _ in O.R_COLS]), "R"))
def q_null_counts(spark, sf_dir):
    return quality_ops.null_counts(readings(spark, sf_dir))


def _completeness_sql() -> str:
    rows = []
    for c, kind in O.R_COLS:
        nulls = f"count(*) FILTER (WHERE {O.q(c)} IS NULL)"
        if kind == "str":
            empties = f"count(*) FILTER (WHERE {O.q(c)} = '')"
            empty_breach = f"{O.pct(empties, 'count(*)')} > 10e0"
        else:
            empties, empty_breach = "CAST(NULL AS BIGINT)", "CAST(NULL AS BOOLEAN)"
        rows.append(f"SELECT {O.lit(c)} AS column_name, count(*) AS total_rows, {nulls} AS null_count, "
                    f"{empties} AS empty_count, 100e0 - {O.pct(nulls, 'count(*)')} AS completeness_pct, "
                    f"{O.pct(nulls, 'count(*)')} > 10e0 AS null_breach, {empty_breach} AS empty_breach "
                    f"FROM R")
    return O.sql(O.union_rows(rows), "R")


@register("completeness", _completeness_sql())
def q_completeness(spark, sf_dir):
    return quality_ops.completeness(readings(spark, sf_dir), READINGS)


@register("range_stats", O.sql(O.union_rows([
    f"SELECT {O.lit(f)} AS field, CAST(min({O.q(f)}) AS DOUBLE) AS min_value, "
    f"CAST(max({O.q(f)}) AS DOUBLE) AS max_value, avg({O.q(f)}) AS avg_value, "
    f"count({O.q(f)}) AS n_values FROM R" for f, _, _ in O.R_RULES]), "R"))
def q_range_stats(spark, sf_dir):
    return quality_ops.range_stats(readings(spark, sf_dir), READINGS)


@register("range_violations", O.sql(O.union_rows([
    f"SELECT {O.lit(f)} AS field, {O.dbl(lo)} AS lower_bound, {O.dbl(hi)} AS upper_bound, "
    f"count(*) FILTER (WHERE {O.q(f)} < {O.dbl(lo)}) AS min_violations, "
    f"count(*) FILTER (WHERE {O.q(f)} > {O.dbl(hi)}) AS max_violations, "
    f"count(*) FILTER (WHERE {O.q(f)} < {O.dbl(lo)} OR {O.q(f)} > {O.dbl(hi)}) = 0 AS valid FROM R"
    for f, lo, hi in O.R_RULES]), "R"))
def q_range_violations(spark, sf_dir):
    return quality_ops.range_violations(readings(spark, sf_dir), READINGS)


def _duplicates_sql(src: str, keys: list[str], *ctes: str) -> str:
    k = ", ".join(O.q(c) for c in keys)
    p = O.pct("t - u", "t")
    return O.sql(
        f"SELECT t AS total_rows, u AS unique_rows, t - u AS duplicate_count, {p} AS duplicate_pct, "
        f"{p} <= 10e0 AS valid FROM (SELECT CAST(coalesce(sum(_m), 0) AS BIGINT) AS t, count(*) AS u "
        f"FROM (SELECT count(*) AS _m FROM {src} GROUP BY {k}) g) s", *ctes)


@register("duplicates_full", _duplicates_sql("R", [c for c, _ in O.R_COLS], "R"))
def q_duplicates_full(spark, sf_dir):
    return quality_ops.duplicates(readings(spark, sf_dir), None, READINGS)


@register("duplicates_by_key", _duplicates_sql("lineitem", ["l_orderkey", "l_linenumber"]))
def q_duplicates_by_key(spark, sf_dir):
    return quality_ops.duplicates(table(spark, sf_dir, "lineitem"),
                                  ["l_orderkey", "l_linenumber"], READINGS)


@register("temporal_check", f"""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE ts IS NULL) AS invalid_dates,
       count(*) FILTER (WHERE ts > TIMESTAMP '{EVENTS_AS_OF}') AS future_dates,
       min(ts) AS min_ts, max(ts) AS max_ts,
       count(*) FILTER (WHERE ts IS NULL) = 0
         AND count(*) FILTER (WHERE ts > TIMESTAMP '{EVENTS_AS_OF}') = 0 AS valid
FROM events""")
def q_temporal_check(spark, sf_dir):
    return quality_ops.temporal_check(table(spark, sf_dir, "events"), "ts", EVENTS_AS_OF)


@register("temporal_gaps", """
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
              WHERE o_orderdate IS NOT NULL),
     n AS (SELECT d, lead(d) OVER (ORDER BY d) AS nxt FROM days)
SELECT CAST(d + 1 AS DATE) AS gap_start, CAST(nxt - 1 AS DATE) AS gap_end,
       CAST(datediff('day', d, nxt) - 1 AS BIGINT) AS missing_days
FROM n WHERE datediff('day', d, nxt) > 1""")
def q_temporal_gaps(spark, sf_dir):
    return quality_ops.temporal_gaps(table(spark, sf_dir, "orders"), "o_orderdate")


@register("schema_check", O.sql("""SELECT field, issue, expected_type, actual_type, n_rows, n_values FROM (
  SELECT count(*) AS n_rows, count(formatted_date) AS dates, count(reading_id) AS ids FROM R) c, LATERAL (VALUES
  ('Formatted Date', 'type', 'timestamp', 'timestamp_ntz', c.dates),
  ('Precip Type', 'missing', 'string', NULL, 0),
  ('Apparent Temperature (C)', 'missing', 'double', NULL, 0),
  ('Wind Bearing (degrees)', 'missing', 'double', NULL, 0),
  ('Loud Cover', 'missing', 'double', NULL, 0),
  ('Daily Summary', 'missing', 'string', NULL, 0),
  ('reading_id', 'extra', NULL, 'bigint', c.ids)
) AS t(field, issue, expected_type, actual_type, n_values)""", "R"))
def q_schema_check(spark, sf_dir):
    return quality_ops.schema_check(raw_readings(spark, sf_dir), RAW_CONTRACT)


@register("full_validation", O.sql(_R_QUALITY.long_body(), "R", extra=tuple(_R_QUALITY.ctes())))
def q_full_validation(spark, sf_dir):
    return quality_ops.full_validation(readings(spark, sf_dir), READINGS, STANDARD_CONTRACT,
                                       READINGS_AS_OF)


def _summary_sql(long_sql_body: str) -> str:
    return (f"SELECT count(*) AS total_validations, count(*) FILTER (WHERE ok) AS passed_validations, "
            f"count(*) FILTER (WHERE NOT ok) AS failed_validations, "
            f"coalesce(bool_and(ok), true) AS overall_valid FROM ("
            f"SELECT check_name, bool_and(valid) AS ok FROM ({long_sql_body}) v GROUP BY check_name) c")


@register("validation_summary", O.sql(_summary_sql(_R_QUALITY.long_body()), "R",
                                      extra=tuple(_R_QUALITY.ctes())))
def q_validation_summary(spark, sf_dir):
    return quality_ops.validation_summary(q_full_validation(spark, sf_dir))


@register("quality_report", O.sql(_R_QUALITY.report_body(), "R", extra=tuple(_R_QUALITY.ctes())))
def q_quality_report(spark, sf_dir):
    return report_ops.quality_report(readings(spark, sf_dir), READINGS, STANDARD_CONTRACT,
                                     READINGS_AS_OF)


@register("feature_validation", O.sql(_F_QUALITY.long_body(), "F", extra=tuple(_F_QUALITY.ctes())))
def q_feature_validation(spark, sf_dir):
    return quality_ops.full_validation(features(spark, sf_dir), FEATURES, None, READINGS_AS_OF)


_R_NAMES = ", ".join(O.q(c) for c, _ in O.R_COLS)
_INVALID = f"NOT coalesce({O.VALID_PRESSURE}, false)"


@register("quarantine_rows", O.sql(f"""
SELECT {_R_NAMES}, 'duplicate' AS reason, _m - 1 AS copies FROM G WHERE _m > 1
UNION ALL
SELECT {_R_NAMES}, 'null_critical' AS reason, 1 AS copies FROM G WHERE NOT {O.CRITICAL_OK}
UNION ALL
SELECT {_R_NAMES}, 'invalid_pressure' AS reason, 1 AS copies FROM G WHERE {O.CRITICAL_OK} AND {_INVALID}""",
    "R", extra=(f"G AS (SELECT {_R_NAMES}, count(*) AS _m FROM R GROUP BY {_R_NAMES})",)))
def q_quarantine_rows(spark, sf_dir):
    return quality_ops.quarantine_rows(readings(spark, sf_dir), READINGS)


def _stage_sql() -> str:
    g = (f"G AS (SELECT count(*) AS _m, NOT {O.CRITICAL_OK} AS _null, {_INVALID} AS _inv "
         f"FROM R GROUP BY {_R_NAMES})")
    s = ("S AS (SELECT CAST(coalesce(sum(_m), 0) AS BIGINT) AS raw_total, "
         "CAST(coalesce(sum(CASE WHEN _null THEN _m END), 0) AS BIGINT) AS raw_null, "
         "CAST(coalesce(sum(CASE WHEN _inv THEN _m END), 0) AS BIGINT) AS raw_inv, "
         "count(*) AS dd_total, count(*) FILTER (WHERE _null) AS dd_null, "
         "count(*) FILTER (WHERE _inv) AS dd_inv, count(*) FILTER (WHERE NOT _null) AS nn_total, "
         "count(*) FILTER (WHERE NOT _null AND _inv) AS nn_inv, "
         "count(*) FILTER (WHERE NOT _null AND NOT _inv) AS cl_total FROM G)")

    def stage(name, total, nulls, dups, inv):
        valid = f"({total}) - ({nulls}) - ({dups}) - ({inv})"
        return (f"SELECT {O.lit(name)} AS stage, {total} AS total_rows, {valid} AS valid_rows, "
                f"CAST({nulls} AS BIGINT) AS null_rows, CAST({dups} AS BIGINT) AS duplicate_rows, "
                f"CAST({inv} AS BIGINT) AS invalid_rows, {O.pct(valid, total)} AS valid_pct FROM S")
    body = O.union_rows([
        stage("raw", "raw_total", "raw_null", "raw_total - dd_total", "raw_inv"),
        stage("deduplicated", "dd_total", "dd_null", "0", "dd_inv"),
        stage("non_null", "nn_total", "0", "0", "nn_inv"),
        stage("cleaned", "cl_total", "0", "0", "0")])
    return O.sql(body, "R", extra=(g, s))


@register("stage_quality_metrics", _stage_sql())
def q_stage_quality_metrics(spark, sf_dir):
    return quality_ops.stage_quality_metrics(readings(spark, sf_dir), READINGS)


# -- profiles and summaries ----------------------------------------------------

_R_TYPES = {"reading_id": "bigint", "formatted_date": "timestamp_ntz", "summary": "string"}


@register("column_profile", O.sql(O.union_rows([
    f"SELECT {i + 1} AS ordinal, {O.lit(c)} AS column_name, "
    f"{O.lit(_R_TYPES.get(c, 'double'))} AS data_type, true AS nullable, count(*) AS total_rows, "
    f"count(*) FILTER (WHERE {O.q(c)} IS NULL) AS null_count FROM R"
    for i, (c, _) in enumerate(O.R_COLS)]), "R"))
def q_column_profile(spark, sf_dir):
    return profiling_ops.column_profile(readings(spark, sf_dir))


_D_NUMERIC = ["n_rows", "unique_days", "avg_tempC", "max_tempC", "min_tempC", "std_tempC",
              "avg_humidity", "avg_wind_speed", "avg_pressure", "avg_visibility"]


@register("describe_stats", O.sql(O.union_rows([
    f"SELECT {O.lit(c)} AS column_name, count({O.q(c)}) AS n, "
    f"round(avg(CAST({O.q(c)} AS DOUBLE)), 6) AS mean, "
    f"round(stddev_samp(CAST({O.q(c)} AS DOUBLE)), 6) AS stddev, "
    f"round(min(CAST({O.q(c)} AS DOUBLE)), 6) AS min, round(max(CAST({O.q(c)} AS DOUBLE)), 6) AS max "
    f"FROM DR" for c in _D_NUMERIC]), "D",
    extra=("DR AS (SELECT date, n_rows, unique_days, avg_tempC, max_tempC, min_tempC, "
           "round(std_tempC, 6) AS std_tempC, avg_humidity, avg_wind_speed, avg_pressure, "
           "avg_visibility FROM D)",)))
def q_describe_stats(spark, sf_dir):
    d = rounded(daily(spark, sf_dir), DAILY_INEXACT)
    return rounded(profiling_ops.describe_stats(d, _D_NUMERIC), ("mean", "stddev", "min", "max"))


@register("transform_summary", O.sql(
    "SELECT o AS original_rows, t AS transformed_rows, o - t AS rows_removed, "
    "8 AS original_columns, 24 AS transformed_columns, 16 AS columns_added "
    "FROM (SELECT (SELECT count(*) FROM R) AS o, (SELECT count(*) FROM F) AS t) s", "R", "F"))
def q_transform_summary(spark, sf_dir):
    r = readings(spark, sf_dir)
    staged = clean_ops.staged_rows(r)
    d = daily_ops.daily_agg(clean_ops.clean_readings(staged.drop("copies"), READINGS, remove_duplicates=False), READINGS)
    return profiling_ops.transform_summary(d, len(r.columns), len(feature_ops.daily_features(d).columns), staged=staged)


@register("pipeline_summary", O.sql(
    "SELECT e AS extraction_rows, c AS cleaned_rows, f AS final_rows, "
    "CASE WHEN f > 0 THEN 'SUCCESS' ELSE 'EMPTY' END AS status FROM (SELECT "
    "(SELECT count(*) FROM R) AS e, (SELECT count(*) FROM C) AS c, (SELECT count(*) FROM F) AS f) s",
    "R", "C", "F"))
def q_pipeline_summary(spark, sf_dir):
    staged = clean_ops.staged_rows(readings(spark, sf_dir))
    return profiling_ops.pipeline_summary(staged, daily_ops.daily_agg(clean_ops.clean_readings(
        staged.drop("copies"), READINGS, remove_duplicates=False), READINGS))


# -- sources and sinks -------------------------------------------------------
# Each of these writes under the session's shared checkpoint folder (a fresh
# sub-folder per call) and returns the lazily read-back frame.

_DAILY_SQL = O.sql(f"SELECT {O.DAILY_SELECT} FROM D", "D")
_D_COLUMNS = ("date", "n_rows", "unique_days", "avg_tempC", "max_tempC", "min_tempC", "std_tempC",
              "avg_humidity", "avg_wind_speed", "avg_pressure", "avg_visibility")


@register("parquet_roundtrip", _DAILY_SQL)
def q_parquet_roundtrip(spark, sf_dir):
    res = sinks.write_parquet(daily(spark, sf_dir), shared_dir(spark, "parquet_roundtrip"))
    return rounded(sources.read_parquet(spark, res.path), DAILY_INEXACT)


_TEXT_SQL = O.sql("SELECT * FROM T", "T")


@register("csv_roundtrip", _TEXT_SQL)
def q_csv_roundtrip(spark, sf_dir):
    res = sinks.write_csv(text_readings(spark, sf_dir), shared_dir(spark, "csv_roundtrip"))
    return sinks.read_back(spark, res)


@register("json_roundtrip", _TEXT_SQL)
def q_json_roundtrip(spark, sf_dir):
    res = sinks.write_json(text_readings(spark, sf_dir), shared_dir(spark, "json_roundtrip"))
    return sinks.read_back(spark, res)


@register("partitioned_roundtrip", _DAILY_SQL)
def q_partitioned_roundtrip(spark, sf_dir):
    d = daily(spark, sf_dir)
    d = d.withColumns({"year": F.year("date"), "month": F.month("date")})
    res = sinks.write_parquet(d, shared_dir(spark, "partitioned_roundtrip"),
                              partition_by=["year", "month"])
    back = sources.read_parquet(spark, res.path)
    return rounded(back.select(*_D_COLUMNS), DAILY_INEXACT)


def _raw_csv_frame(spark, sf_dir):
    """Readings as a raw sensor CSV would hold them: the 12 contract fields in
    contract order (fields the view lacks are empty), then reading_id."""
    raw = raw_readings(spark, sf_dir)
    cols = []
    for f in RAW_CONTRACT.fields:
        if f.name in raw.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return raw.select(*cols, "reading_id")


_RAW_CSV_SCHEMA = T.StructType(RAW_CONTRACT.fields + [T.StructField("reading_id", T.LongType())])


@register("csv_scan", _DAILY_SQL)
def q_csv_scan(spark, sf_dir):
    path = shared_dir(spark, "csv_scan")
    # The file is the query's input, not its output: the scan below is what is checked.
    sinks.write_csv(_raw_csv_frame(spark, sf_dir), path, timestamp_format=TIMESTAMP_FORMAT, verify=False)
    scanned = sources.read_csv(spark, path, schema=_RAW_CSV_SCHEMA, expected=RAW_CONTRACT)
    cleaned_df = clean_ops.clean_readings(scanned, READINGS)
    return rounded(daily_ops.daily_agg(cleaned_df, READINGS), DAILY_INEXACT)


@register("csv_glob_scan", _DAILY_SQL)
def q_csv_glob_scan(spark, sf_dir):
    base = shared_dir(spark, "csv_glob_scan")
    d = daily(spark, sf_dir)
    early = F.col("date") < F.lit("1998-01-01").cast("date")
    sinks.write_csv(d.where(early), f"{base}/first_half", verify=False)
    sinks.write_csv(d.where(~early | F.col("date").isNull()), f"{base}/second_half", verify=False)
    back = sources.read_csv_glob(spark, base, "*.csv", schema=d.schema)
    return rounded(back, DAILY_INEXACT)


# A CSV file with line breaks in quotes, ragged lines and bad values: which
# records are good and which lines are set aside, and why.
_LINE_KINDS = """CASE WHEN l_linenumber = 1 AND l_orderkey % 7 = 0 THEN 'break'
  WHEN l_linenumber = 2 AND l_orderkey % 5 = 0 THEN 'short' WHEN l_linenumber = 3 AND l_orderkey % 3 = 0 THEN 'long'
  WHEN l_linenumber = 4 AND l_orderkey % 2 = 0 THEN 'text' ELSE 'good' END"""


@register("csv_dead_letter", f"""
WITH k AS (SELECT {_LINE_KINDS} AS kind, l_orderkey FROM lineitem)
SELECT CASE kind WHEN 'good' THEN 'record' WHEN 'text' THEN 'value' ELSE 'fields' END AS status,
       count(*) AS n, CAST(sum(CASE WHEN kind = 'good' THEN l_orderkey ELSE 0 END) AS BIGINT) AS key_sum
FROM k WHERE kind <> 'break' GROUP BY 1
UNION ALL
SELECT 'open_quote' AS status, 2 * count(*) AS n, 0 AS key_sum FROM k WHERE kind = 'break' HAVING count(*) > 0""")
def q_csv_dead_letter(spark, sf_dir):
    path = shared_dir(spark, "csv_dead_letter")
    kind = F.expr(_LINE_KINDS)
    key, mode = F.col("l_orderkey").cast("string"), F.col("l_returnflag")
    quoted = F.concat(F.lit('"'), mode, F.lit(', ""so"""'))
    line = (F.when(kind == "break", F.concat(key, F.lit(',"'), mode, F.lit('\nrest",'), F.col("l_quantity")))
            .when(kind == "short", F.concat_ws(",", key, quoted))
            .when(kind == "long", F.concat_ws(",", key, quoted, F.lit("1.0"), F.lit("2.0")))
            .when(kind == "text", F.concat_ws(",", key, quoted, F.lit("many")))
            .otherwise(F.concat_ws(",", key, quoted, F.col("l_quantity").cast("string"))))
    table(spark, sf_dir, "lineitem").select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("order", T.LongType()), T.StructField("mode", T.StringType()),
                           T.StructField("quantity", T.DoubleType())])
    records, rejected = sources.scan_csv(spark, path, schema)
    good = records.select(F.lit("record").alias("status"), "order")
    both = good.unionByName(rejected.select(F.col("reason").alias("status"), F.lit(0).cast("long").alias("order")))
    return both.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("order").alias("key_sum"))


@register("csv_joined_records", """
SELECT l_returnflag || CASE WHEN l_linenumber % 2 = 1 THEN chr(10) || chr(10) || l_linestatus || ',"' || l_linestatus || '"' ELSE '' END AS note,
       count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum, sum(l_quantity) AS quantity
FROM lineitem GROUP BY 1
UNION ALL
SELECT 'rejected: open_quote' AS note, CAST(1 AS BIGINT) AS n, NULL AS key_sum, NULL AS quantity FROM lineitem HAVING count(*) > 0""")
def q_csv_joined_records(spark, sf_dir):
    """Every other line's note holds line breaks, a separator and quotes; a file of its own
    holds a quote that is never closed."""
    path = shared_dir(spark, "csv_joined_records")
    items = table(spark, sf_dir, "lineitem")
    text = F.concat(F.lit('"'), "l_returnflag", F.when(F.col("l_linenumber") % 2 == 1, F.concat(
        F.lit("\n\n"), "l_linestatus", F.lit(',""'), "l_linestatus", F.lit('""'))).otherwise(F.lit("")), F.lit('"'))
    line = F.concat_ws(",", F.col("l_orderkey").cast("string"), text, F.col("l_quantity").cast("string"))
    items.select(line.alias("value")).write.text(f"{path}/whole")
    items.agg(F.concat(F.max("l_orderkey").cast("string"), F.lit(',"open,1')).alias("value")).where("value is not null").write.text(f"{path}/open")
    schema = T.StructType([T.StructField("order", T.LongType()), T.StructField("note", T.StringType()),
                           T.StructField("quantity", T.DoubleType())])
    records, rejected = sources.scan_csv(spark, f"{path}/*", schema, join_breaks=True)
    bad = rejected.select(F.concat(F.lit("rejected: "), "reason").alias("note"), F.lit(None).cast("long").alias("order"),
                          F.lit(None).cast("double").alias("quantity"))
    return records.select("note", "order", "quantity").unionByName(bad).groupBy("note").agg(
        F.count(F.lit(1)).alias("n"), F.sum("order").alias("key_sum"), F.sum("quantity").alias("quantity"))


# Each format stands first once: later formats must not inherit its losses.
FORMAT_ORDERS = (("parquet", "csv", "json"), ("csv", "json", "parquet"), ("json", "parquet", "csv"))


def _text_formats(spark, sf_dir, name: str, formats=FORMAT_ORDERS[0], verify: bool = True):
    return sinks.write_multiple_formats(text_readings(spark, sf_dir), shared_dir(spark, name), formats, verify=verify)


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("multi_format_counts", O.sql(O.union_rows([
    f"SELECT '{order[0]}' AS first_format, '{fmt}' AS format, count(*) AS n_rows, "
    f"count(note) AS n_notes, count(DISTINCT note) AS distinct_notes, min(seen_at) AS min_seen, max(seen_at) AS max_seen FROM T"
    for order in FORMAT_ORDERS for fmt in order]), "T"))
def q_multi_format_counts(spark, sf_dir):
    return _union([
        sinks.read_back(spark, r).agg(
            F.count(F.lit(1)).alias("n_rows"), F.count("note").alias("n_notes"), F.count_distinct("note").alias("distinct_notes"),
            F.min("seen_at").alias("min_seen"), F.max("seen_at").alias("max_seen"))
        .select(F.lit(order[0]).alias("first_format"), F.lit(fmt).alias("format"), "*")
        for order in FORMAT_ORDERS
        for fmt, r in _text_formats(spark, sf_dir, "multi_format", order, verify=False).items()])


@register("write_verification", O.sql(O.union_rows([
    f"SELECT '{fmt}' AS format, count(*) AS expected_rows, count(*) AS actual_rows, 10 AS expected_columns, "
    f"10 AS actual_columns, true AS checksum_match, true AS valid FROM T" for fmt in FORMAT_ORDERS[1]]), "T"))
def q_write_verification(spark, sf_dir):
    results = _text_formats(spark, sf_dir, "write_verification", FORMAT_ORDERS[1], verify=False)
    return _union([r.verification(spark).select(F.lit(fmt).alias("format"), "*") for fmt, r in results.items()])


@register("load_summary", O.sql(O.union_rows([
    f"SELECT '{fmt}' AS format, count(*) AS n_rows, 10 AS n_columns, true AS has_files, true AS has_bytes FROM T"
    for fmt in FORMAT_ORDERS[0]]), "T"))
def q_load_summary(spark, sf_dir):
    # Byte sizes and file counts depend on the engine's encoders and tasks.
    summary = sinks.load_summary(spark, _text_formats(spark, sf_dir, "load_summary", verify=False))
    return summary.select("format", "n_rows", "n_columns", (F.col("n_files") > 0).alias("has_files"),
                          (F.col("total_bytes") > 0).alias("has_bytes"))


@register("publish_versions", O.sql("""
SELECT 1 AS version, count(*) AS n_rows, false AS live FROM D WHERE date < DATE '1998-01-01'
UNION ALL SELECT 2 AS version, count(*) AS n_rows, false AS live FROM D WHERE date < DATE '2000-01-01'
UNION ALL SELECT 3 AS version, count(*) AS n_rows, true AS live FROM D""", "D"))
def q_publish_versions(spark, sf_dir):
    versions = sinks.VersionedTable(spark, shared_dir(spark, "publish_versions"))
    all_days = daily(spark, sf_dir)
    whole = {"has_days": F.count(F.lit(1)) > 0, "days_known": F.count_if(F.col("date").isNull()) == 0}
    versions.publish(all_days.where(F.col("date") < F.lit("1998-01-01").cast("date")), require=whole)
    versions.publish(all_days.where(F.col("date") < F.lit("2000-01-01").cast("date")), require=whole)
    try:  # the readings as they come hold rows without a date: not published
        versions.publish(daily_ops.daily_agg(readings(spark, sf_dir), READINGS), require=whole)
    except sinks.VerificationError:
        pass
    versions.publish(all_days, partition_by=["unique_days"], require=whole)
    return versions.history().select("version", "n_rows", "live")


@register("compact_small_files", O.sql("""
SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS n_days, CAST(sum(n_rows) AS BIGINT) AS n_rows, sum(min_tempC) AS min_sum,
       true AS merged, true AS fits FROM D GROUP BY year(date)""", "D"))
def q_compact_small_files(spark, sf_dir):
    path = shared_dir(spark, "compact_small_files")
    days = daily(spark, sf_dir).withColumn("year", F.year("date"))
    # Many writers, each with a small file in every year.
    days.repartition(6, F.hash("date")).write.partitionBy("year").parquet(path)
    counted = sinks.write_parquet(_files_by_year(spark, path), shared_dir(spark, "compact_counts"), verify=False)
    before = sinks.read_back(spark, counted)  # counted now: the files themselves go
    bins = sinks.compact_files(spark, path).groupBy(
        F.regexp_extract("directory", "year=(\\d+)", 1).cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("bins"), F.sum("files").alias("replaced"))
    after = _files_by_year(spark, path).withColumnRenamed("n_files", "n_after")
    rows = spark.read.parquet(path).groupBy("year").agg(
        F.count(F.lit(1)).alias("n_days"), F.sum("n_rows").alias("n_rows"), F.sum("min_tempC").alias("min_sum"))
    joined = rows.join(before, "year").join(after, "year").join(bins, "year", "left")
    kept = F.col("n_files") - F.coalesce("replaced", F.lit(0)) + F.coalesce("bins", F.lit(0))
    return joined.select("year", "n_days", "n_rows", "min_sum", ((F.col("n_after") < F.col("n_files")) | (F.col("n_files") == 1)).alias("merged"),
                         (F.col("n_after") == kept).alias("fits"))


def _files_by_year(spark, path):
    files = spark.read.parquet(path).select("year", F.col("_metadata.file_path").alias("file"))
    return files.groupBy("year").agg(F.count_distinct("file").alias("n_files"))


@register("parquet_scan", """
SELECT event_type, count(*) AS n, round(avg(value), 6) AS avg_value FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' GROUP BY event_type""")
def q_parquet_scan(spark, sf_dir):
    ev = sources.read_parquet(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    # The date predicate and the 3-column projection reach the Parquet reader.
    out = (ev.where(F.col("ts") >= F.to_timestamp_ntz(F.lit("2024-01-10 00:00:00")))
           .groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("avg_value")))
    return rounded(out, ("avg_value",))



# -- documented extensions (lookup join, increments, streams, statistics) -------

@register("lookup_join", """
SELECT p_brand, CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(*) AS n,
       avg(l_quantity) AS avg_quantity
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_brand, year(l_shipdate)""")
def q_lookup_join(spark, sf_dir):
    joined = join_ops.lookup_join(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"),
                                  "l_partkey", "p_partkey", ["p_brand"])
    return joined.groupBy("p_brand", F.year("l_shipdate").alias("ship_year")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("avg_quantity"))


@register("metric_correlation", O.sql(O.union_rows([
    f"SELECT {O.lit(a)} AS metric_a, {O.lit(b)} AS metric_b, round(corr({O.q(a)}, {O.q(b)}), 6) AS corr FROM C"
    for a, b in combinations(analytics_ops.METRICS, 2)]), "C"))
def q_metric_correlation(spark, sf_dir):
    return rounded(analytics_ops.metric_correlation(cleaned(spark, sf_dir)), ("corr",))


def _spearman_sql() -> str:
    pairs = [f"""SELECT {O.lit(a)} AS metric_a, {O.lit(b)} AS metric_b, count(*) AS n, round(corr(rx, ry), 6) AS corr FROM (
      SELECT rank() OVER (ORDER BY {O.q(a)}) + (count(*) OVER (PARTITION BY {O.q(a)}) - 1) / 2.0e0 AS rx,
             rank() OVER (ORDER BY {O.q(b)}) + (count(*) OVER (PARTITION BY {O.q(b)}) - 1) / 2.0e0 AS ry
      FROM C WHERE {O.q(a)} IS NOT NULL AND {O.q(b)} IS NOT NULL) t""" for a, b in combinations(analytics_ops.METRICS, 2)]
    return O.sql(O.union_rows(pairs), "C")


@register("rank_correlation", _spearman_sql())
def q_rank_correlation(spark, sf_dir):
    return rounded(analytics_ops.rank_correlation(cleaned(spark, sf_dir)), ("corr",))


@register("series_features", """
WITH D AS (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS date, max(floor(o_totalprice)) AS top FROM orders GROUP BY ALL)
SELECT o_orderstatus, date, top, round(avg(top) OVER w7, 6) AS temp_7d_avg, round(avg(top) OVER w30, 6) AS temp_30d_avg,
       min(top) OVER w7 AS temp_7d_min, max(top) OVER w7 AS temp_7d_max,
       top - first(top) OVER (PARTITION BY o_orderstatus ORDER BY date RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS temp_change_1d,
       top - first(top) OVER (PARTITION BY o_orderstatus ORDER BY date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 7 DAY PRECEDING) AS temp_change_7d
FROM D WINDOW w7 AS (PARTITION BY o_orderstatus ORDER BY date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW),
              w30 AS (PARTITION BY o_orderstatus ORDER BY date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)""")
def q_series_features(spark, sf_dir):
    top = table(spark, sf_dir, "orders").groupBy("o_orderstatus", F.to_date("o_orderdate").alias("date")).agg(
        F.max(F.floor("o_totalprice").cast("double")).alias("top"))  # whole numbers: means are alike in any order
    out = feature_ops.daily_features(top, "top", scope="series", series_keys=("o_orderstatus",))
    return rounded(out.select("o_orderstatus", "date", "top", "temp_7d_avg", "temp_30d_avg", "temp_7d_min", "temp_7d_max",
                              "temp_change_1d", "temp_change_7d"),
                   ("temp_7d_avg", "temp_30d_avg"))


_SEASON_SQL = ("CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) IN (3, 4, 5) "
               "THEN 'Spring' WHEN month(date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END")


@register("seasonal_stats", O.sql("""
SELECT season, n, round(mu, 6) AS mean, round(p50, 6) AS p50,
       round(m3 / pow(m2, 1.5), 6) AS skewness, round(m4 / (m2 * m2) - 3, 6) AS kurtosis
FROM (SELECT S.season, M.n, M.mu, M.p50,
             avg(pow(x - M.mu, 2)) AS m2, avg(pow(x - M.mu, 3)) AS m3, avg(pow(x - M.mu, 4)) AS m4
      FROM S JOIN M ON S.season = M.season GROUP BY S.season, M.n, M.mu, M.p50) t""", "D",
    extra=(f"S AS (SELECT {_SEASON_SQL} AS season, avg_tempC AS x FROM D)",
           "M AS (SELECT season, count(x) AS n, avg(x) AS mu, quantile_cont(x, 0.5) AS p50 "
           "FROM S GROUP BY season)")))
def q_seasonal_stats(spark, sf_dir):
    return rounded(analytics_ops.seasonal_stats(daily(spark, sf_dir)),
                   ("mean", "p50", "skewness", "kurtosis"))


@register("seasonal_decomposition", O.sql("""
SELECT date, observed, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
       round(observed - trend - seasonal, 6) AS remainder FROM S""", "D",
    extra=("T AS (SELECT date, avg_tempC AS observed, avg(avg_tempC) OVER (PARTITION BY year(date), "
           "month(date) ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS trend FROM D)",
           "S AS (SELECT *, avg(observed - trend) OVER (PARTITION BY month(date)) AS seasonal FROM T)")))
def q_seasonal_decomposition(spark, sf_dir):
    return rounded(analytics_ops.seasonal_decomposition(daily(spark, sf_dir)),
                   ("trend", "seasonal", "remainder"))


@register("anomaly_zscore", O.sql("""
SELECT date, avg_tempC, round(z, 6) AS zscore FROM (
  SELECT date, avg_tempC, CASE WHEN sd > 0 THEN (avg_tempC - mu) / sd END AS z FROM (
    SELECT date, avg_tempC,
           avg(avg_tempC) OVER w AS mu, stddev_samp(avg_tempC) OVER w AS sd
    FROM D WINDOW w AS (PARTITION BY year(date), month(date) ORDER BY date
                        ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) a) b
WHERE abs(z) > 3""", "D"))
def q_anomaly_zscore(spark, sf_dir):
    return rounded(analytics_ops.anomaly_zscore(daily(spark, sf_dir)), ("zscore",))


_SHIFTING = ("n_rows", "avg_tempC", "avg_humidity", "avg_pressure")


# The same least-cost segmentation, without dropping any start on the way.
@register("change_points", O.sql("""
SELECT metric, segment, start_date, end_date, n_days, round(mean, 6) AS mean,
       round(mean - lag(mean) OVER (PARTITION BY metric ORDER BY segment), 6) AS change
FROM (SELECT c.metric, CAST(row_number() OVER (PARTITION BY c.metric ORDER BY c.b) AS INTEGER) AS segment, min(p.date) AS start_date,
             max(p.date) AS end_date, CAST(c.b - c.a AS INTEGER) AS n_days, avg(p.v) AS mean
      FROM CUTS c JOIN P p ON p.metric = c.metric AND p.i > c.a AND p.i <= c.b GROUP BY c.metric, c.a, c.b)""", "D",
    extra=(f"U AS ({' UNION ALL '.join(f'SELECT {chr(39)}{m}{chr(39)} AS metric, date, CAST({m} AS DOUBLE) AS v FROM D WHERE {m} IS NOT NULL' for m in _SHIFTING)})",
           "P AS (SELECT *, row_number() OVER w AS i, v - avg(v) OVER (PARTITION BY metric) AS x, abs(v - lag(v) OVER w) AS step "
           "FROM U WINDOW w AS (PARTITION BY metric ORDER BY date))",
           "Q AS (SELECT metric, i, step, sum(x) OVER w AS s, sum(x * x) OVER w AS q FROM P WINDOW w AS (PARTITION BY metric ORDER BY i))",
           "A AS (SELECT metric, count(*) AS n, list_prepend(0e0, list(s ORDER BY i)) AS s, list_prepend(0e0, list(q ORDER BY i)) AS q, "
           "greatest(CASE WHEN count(*) > 1 THEN 3e0 * pow(median(step) / 0.9539e0, 2) * ln(count(*)) ELSE 0e0 END, 1e-6) AS beta "
           "FROM Q GROUP BY metric)",
           "STEPS(metric, t, costs, cuts) AS (SELECT metric, CAST(0 AS BIGINT), [0e0], CAST([] AS BIGINT[]) FROM A UNION ALL "
           "SELECT metric, t + 1, list_append(costs, best.cost), list_append(cuts, best.at) FROM ("
           "SELECT r.metric, r.t, r.costs, r.cuts, list_min(list_transform(range(r.t + 1), lambda j: {'cost': r.costs[j + 1] "
           "+ (A.q[r.t + 2] - A.q[j + 1]) - pow(A.s[r.t + 2] - A.s[j + 1], 2) / (r.t + 1 - j) + A.beta, 'at': j})) AS best "
           "FROM STEPS r JOIN A ON A.metric = r.metric WHERE r.t < A.n))",
           "CUTS(metric, a, b, cuts) AS (SELECT r.metric, r.cuts[A.n], A.n, r.cuts FROM STEPS r JOIN A ON A.metric = r.metric AND A.n = r.t "
           "UNION ALL SELECT metric, cuts[a], a, cuts FROM CUTS WHERE a > 0)")).replace("WITH ", "WITH RECURSIVE ", 1))
def q_change_points(spark, sf_dir):
    d = daily(spark, sf_dir)
    series = d.select("date", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in _SHIFTING])).alias("s"))
    found = analytics_ops.change_points(series.select("date", "s.*"), "v", series_keys=("metric",))
    return rounded(found, ("mean", "change"))


@register("full_job_summary", O.sql(
    "SELECT (SELECT count(*) FROM R) AS extraction_rows, (SELECT count(*) FROM C) AS cleaned_rows, "
    "(SELECT count(*) FROM F) AS final_rows, 'SUCCESS' AS status, "
    "(SELECT count(*) FROM R) - (SELECT count(*) FROM C) AS rejected_rows, (SELECT count(*) FROM F) * 2 AS loaded_rows", "R", "C", "F"))
def q_full_job_summary(spark, sf_dir):
    job = run_job(spark, readings(spark, sf_dir), shared_dir(spark, "full_job"), as_of=READINGS_AS_OF,
                  formats=("parquet", "json"), on_fail="quarantine")
    rejected = spark.read.parquet(job.rejected_path).agg(F.sum("copies").alias("rejected_rows"))
    loaded = job.loads.agg(F.sum("n_rows").alias("loaded_rows"))
    frames = (job.summary, rejected, loaded)
    merged = _union([f.select(*[F.col(c) if c in f.columns else F.lit(None).alias(c) for g in frames for c in g.columns])
                     for f in frames])
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


INCREMENT_CUTOFF = "1998-06-15 00:00:00"


@register("incremental_equals_full", O.sql(f"SELECT {O.FEATURES_SELECT} FROM F", "F"))
def q_incremental_equals_full(spark, sf_dir):
    path = shared_dir(spark, "incremental")
    table_df = incremental.incremental_run(spark, readings(spark, sf_dir), INCREMENT_CUTOFF, path)
    order = feature_ops_columns()
    return rounded(table_df.select(*order), FEATURE_INEXACT)


def _overlapping_batches(spark, sf_dir) -> list[DataFrame]:
    """Three batches of readings; each row stands in two of them."""
    r = readings(spark, sf_dir)
    return [r.where(F.pmod("reading_id", F.lit(3)) != left_out) for left_out in (2, 0, 1)]


@register("incremental_merge", O.sql(f"SELECT {O.FEATURES_SELECT} FROM F", "F"))
def q_incremental_merge(spark, sf_dir):
    state = daily_state.DailyState(spark, shared_dir(spark, "incremental_merge"))
    for number, batch in enumerate(_overlapping_batches(spark, sf_dir)):
        state.add(batch, number)
    return rounded(state.features().select(*feature_ops_columns()), FEATURE_INEXACT)


@register("dedup_across_batches", O.sql("""
SELECT batch_id, count(*) AS n_rows, CAST(sum(new) AS BIGINT) AS n_new, CAST(sum(new * reading_id) AS BIGINT) AS new_id_sum FROM (
  SELECT b.batch_id, reading_id, CASE WHEN copy = 1 AND NOT (b.batch_id = 1 AND reading_id % 3 = 1) AND b.batch_id < 2 THEN 1 ELSE 0 END AS new
  FROM (SELECT *, row_number() OVER (PARTITION BY R ORDER BY reading_id) AS copy FROM R) r
  JOIN (VALUES (0, 2), (1, 0), (2, 1)) b(batch_id, left_out) ON reading_id % 3 <> left_out) t GROUP BY batch_id""", "R"))
def q_dedup_across_batches(spark, sf_dir):
    # A quarter of the rows expected and more; there are about a tenth more readings than lines.
    words = max(1 << 22, table(spark, sf_dir, "lineitem").count() // 3)
    seen = SeenRows(spark, shared_dir(spark, "dedup_across_batches"), words=words)
    frames = []
    for number, batch in enumerate(_overlapping_batches(spark, sf_dir)):
        got = seen.accept(batch, number)
        frames.append(got.rows.agg(F.coalesce(F.sum("reading_id"), F.lit(0)).alias("new_id_sum")).select(
            F.lit(number).alias("batch_id"), F.lit(got.n_rows).cast("long").alias("n_rows"),
            F.lit(got.n_new).cast("long").alias("n_new"), "new_id_sum"))
    return _union(frames)


def feature_ops_columns() -> list[str]:
    return list(_D_COLUMNS) + ["year", "month", "day_of_week", "quarter",
                               *feature_ops.ROLLING_COLUMNS, *feature_ops.LAG_COLUMNS,
                               "is_weekend", "season"]


@register("stream_daily_agg", """
SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS n, round(avg(value), 6) AS avg_value
FROM events GROUP BY CAST(ts AS DATE), event_type""")
def q_stream_daily_agg(spark, sf_dir):
    base = shared_dir(spark, "stream_daily_agg")
    schema = table(spark, sf_dir, "events").schema
    out = streaming.daily_event_stream(spark, sf_dir.rstrip("/"), "events.parquet", schema,
                                       f"{base}/out", f"{base}/checkpoint")
    return rounded(out, ("avg_value",))


@register("stream_features", O.sql(f"SELECT {O.FEATURES_SELECT} FROM F", "F"))
def q_stream_features(spark, sf_dir):
    base = shared_dir(spark, "stream_features")
    # The readings as files, one per partition of the table as it is; how many
    # of them a micro-batch takes is the caller's choice (here: all there are).
    r = readings(spark, sf_dir)
    r.write.parquet(f"{base}/incoming")
    out = streaming.feature_stream(spark, f"{base}/incoming", "*.parquet", r.schema,
                                   f"{base}/store", f"{base}/features", f"{base}/checkpoint")
    return rounded(out.select(*feature_ops_columns()), FEATURE_INEXACT)


def _fed_in_turns(spark, sf_dir, name: str, turn, process) -> str:
    """The events as a stream of four turns of new files (``turn``: 0 to 3), a micro-batch each."""
    base = shared_dir(spark, name)
    events = table(spark, sf_dir, "events")
    for number in range(4):
        events.where(turn == number).write.mode("append").parquet(f"{base}/incoming")
        streaming.run_batches(spark, f"{base}/incoming", "*.parquet", events.schema, process, f"{base}/checkpoint")
    return base


_LATE_TURN = "least(3, (day(ts) - 1) // 8 + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END)"


@register("stream_late_rows", f"""
WITH E AS (SELECT *, {_LATE_TURN} AS turn, CAST(ts AS DATE) + 1 AS day_end FROM events),
B AS (SELECT turn, max(ts) AS last FROM E GROUP BY turn),
L AS (SELECT E.*, (SELECT max(last) FROM B WHERE B.turn < E.turn) - INTERVAL 2 DAY AS bound,
             (SELECT max(ts) FROM events) - INTERVAL 2 DAY AS final FROM E)
SELECT CASE WHEN bound IS NOT NULL AND day_end <= bound THEN 'late' WHEN day_end <= final THEN 'closed' ELSE 'open' END AS status,
       event_type, count(*) AS n, round(sum(value), 4) AS total FROM L GROUP BY ALL""")
def q_stream_late_rows(spark, sf_dir):
    days = streaming.LateAwareDays(spark, shared_dir(spark, "late_days"), dt.timedelta(days=2))
    delayed = F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    turn = F.least(F.lit(3), F.floor((F.day("ts") - 1) / 8).cast("int") + delayed)
    _fed_in_turns(spark, sf_dir, "stream_late_rows", turn, days.process)
    late = days.late().select(F.lit("late").alias("status"), "event_type", F.lit(1).cast("long").alias("n"), F.col("value").alias("total"))
    parts = [late] + [f.select(F.lit(s).alias("status"), "event_type", "n", "total") for s, f in (("closed", days.closed()), ("open", days.open()))]
    out = _union(parts).groupBy("status", "event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"))
    return out


SESSION_GAP = dt.timedelta(hours=6)


@register("session_windows", """
WITH E AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
S AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS session FROM E)
SELECT user_id, min(ts) AS start, max(ts) AS last, count(*) AS n, round(sum(value), 4) AS total FROM S GROUP BY user_id, session""")
def q_session_windows(spark, sf_dir):
    sessions = streaming.SessionStream(spark, shared_dir(spark, "sessions"), "user_id", "ts", "value", SESSION_GAP, dt.timedelta(hours=1))
    # Turns of eight days; within one the files' rows come in any order, none is older than the turn before.
    _fed_in_turns(spark, sf_dir, "session_windows", F.least(F.lit(3), F.floor((F.day("ts") - 1) / 8).cast("int")), sessions.process)
    both = sessions.emitted("bigint").unionByName(sessions.open("bigint"))
    return both.withColumn("total", F.round("total", 4))


def _live_quality_sql() -> str:
    ranges = {r.field: r for r in READINGS.range_rules}
    texts, rows = {"summary"}, []
    for c in O.READINGS_COLUMNS.replace(" ", "").split(","):
        name, q = c.strip('"'), c
        r = ranges.get(name)
        low, high = (f"count(*) FILTER ({q} < {r.lower})", f"count(*) FILTER ({q} > {r.upper})") if r else ("NULL::BIGINT", "NULL::BIGINT")
        least, most = (f"min({q})", f"max({q})") if r else ("NULL::DOUBLE", "NULL::DOUBLE")
        empty = f"count(*) FILTER ({q} = '')" if name in texts else "NULL::BIGINT"
        rows.append(f"SELECT {O.lit(name)} AS field, count(*) AS n_rows, count(*) - count({q}) AS nulls, {empty} AS empty, "
                    f"{low} AS below, {high} AS above, {least} AS min, {most} AS max, true AS distinct_near, true AS median_near FROM R")
    return O.sql(O.union_rows(rows), "R")


@register("live_quality", _live_quality_sql())
def q_live_quality(spark, sf_dir):
    base = shared_dir(spark, "live_quality")
    r = readings(spark, sf_dir)
    live = streaming.LiveQuality(spark, f"{base}/quality")
    for turn in range(3):
        r.where(F.pmod("reading_id", F.lit(3)) == turn).write.mode("append").parquet(f"{base}/incoming")
        streaming.run_batches(spark, f"{base}/incoming", "*.parquet", r.schema, live.process, f"{base}/checkpoint")
    found = live.summary((0.5,)).withColumn("median", F.col("quantiles")[0]).drop("quantiles")
    # The estimates against exact counts: within 3 % of the distinct values, 3 % of the ranks from the middle.
    ranged = [x.field for x in READINGS.range_rules]
    medians = found.where(F.col("median").isNotNull()).groupBy().pivot("field", ranged).agg(F.first("median"))
    compared = r.crossJoin(medians.select(*[F.col(c).alias(f"m:{c}") for c in ranged]))  # one row on the right
    exact = compared.agg(*[F.count_distinct(f"`{c}`").alias(f"d:{c}") for c in r.columns],
                         *[((F.count_if(F.col(c) < F.col(f"`m:{c}`")) - 0.03 * F.count(c) <= 0.5 * F.count(c))
                            & (F.count_if(F.col(c) <= F.col(f"`m:{c}`")) + 0.03 * F.count(c) >= 0.5 * F.count(c))).alias(f"m:{c}") for c in ranged])
    truth = exact.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(f"`d:{c}`").alias("exact"),
                 (F.col(f"`m:{c}`") if c in ranged else F.lit(True)).alias("median_near")) for c in r.columns])))
    near = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.03 * F.col("exact"))
    return found.join(truth, "field").select("field", "n_rows", "nulls", "empty", "below", "above", "min", "max",
                                             near.alias("distinct_near"), "median_near")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
