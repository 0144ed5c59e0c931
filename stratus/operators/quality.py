"""Data-quality checks, returned as DataFrames.

All metrics of a frame (null and empty counts, range statistics and
violations, timestamp parse/future counts, duplicate counts) come from ONE
scan and ONE shuffle: a group-by on the duplicate key computes every metric
per key (map-side partial aggregation collapses a hot key before the
shuffle), and a global aggregate combines the per-key results. Every
long-form result below is generated from that single wide row with
``inline``, so a full validation is one query.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions.exprs import any_null, as_timestamp, pct, resolve
from stratus.operators.clean import invalid_condition, staged_rows
from stratus.profile import READINGS, Profile

CHECK_ORDER = ("schema", "completeness", "ranges", "duplicates", "temporal")


def _ts_literal(dtype: T.DataType, as_of: str | datetime) -> str:
    text = as_of if isinstance(as_of, str) else as_of.strftime("%Y-%m-%d %H:%M:%S")
    return f"{'to_timestamp' if isinstance(dtype, T.TimestampType) else 'to_timestamp_ntz'}({_text(text)})"


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _numeric(df: DataFrame, name: str) -> str:
    if isinstance(df.schema[name].dataType, T.NumericType):
        return _q(name)
    # Under ANSI a string compared with a number raises; count bad text as null.
    return f"try_cast({_q(name)} AS DOUBLE)"


def _timestamp(df: DataFrame, name: str, fmt: str) -> str:
    """As :func:`stratus.functions.exprs.as_timestamp`, in SQL."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return f"try_to_timestamp({_q(name)}, {_text(fmt)})"
    return f"CAST({_q(name)} AS TIMESTAMP_NTZ)" if isinstance(dtype, T.DateType) else _q(name)


def _pct(part: str, total: str) -> str:
    return f"(CASE WHEN {total} > 0 THEN 100.0D * {part} / {total} ELSE 0.0D END)"


def _inline(df: DataFrame, structs: list[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*structs)))


class Metric:
    """One decomposable metric: ``op`` over ``arg`` (SQL text), reading column
    ``source`` (None for the row count). ``op`` is rows, count_if, count, min,
    max or sum. Aggregates are SQL text as well: a check of a wide frame has
    hundreds of expressions, and text reaches the JVM in one call."""

    def __init__(self, name: str, source: str | None, op: str, arg: str = "1"):
        self.name, self.source, self.op, self.arg = name, source, op, arg

    def aggregate(self) -> str:
        """The metric over plain rows."""
        return f"{'count' if self.op == 'rows' else self.op}({self.arg})"

    def combine(self) -> str:
        """The metric from per-group partial values in column ``name``."""
        if self.op in ("min", "max", "sum"):
            return f"{self.op}({self.name})"
        return f"coalesce(sum({self.name}), 0L)"

    def weighted(self, m: str) -> str:
        """The metric over groups of identical values, each standing for ``m`` rows."""
        if self.op == "rows":
            return f"coalesce(sum({m}), 0L)"
        if self.op == "count_if":
            return f"coalesce(sum(CASE WHEN {self.arg} THEN {m} END), 0L)"
        if self.op == "count":
            return f"coalesce(sum(CASE WHEN {self.arg} IS NOT NULL THEN {m} END), 0L)"
        return f"sum({self.arg} * {m})" if self.op == "sum" else f"{self.op}({self.arg})"


def _named(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(f"{text} AS {name}") for name, text in expressions.items()]


class QualityPlan:
    """Aggregate expressions for every check of ``profile`` on ``df``.

    Building it is metadata only; ``wide()`` is the lazy one-row frame.
    """

    def __init__(self, df: DataFrame, profile: Profile = READINGS,
                 expected_schema: T.StructType | None = None,
                 as_of: str | datetime | None = None,
                 key_columns: list[str] | None = None,
                 date_column: str | None = None, staged: DataFrame | None = None):
        """``staged``: the (row, copies) form of ``df`` (clean.staged_rows), used
        instead of grouping ``df`` again where the whole row is the key."""
        self.df = df
        self.staged = staged
        self.profile = profile
        self.expected_schema = expected_schema
        self.as_of = as_of
        exempt = {c.lower() for c in profile.completeness_exempt}
        self.columns = [c for c in df.columns if c.lower() not in exempt]
        self.strings = [c for c in self.columns
                        if isinstance(df.schema[c].dataType, T.StringType)]
        rules = [(r, resolve(df, r.field)) for r in profile.range_rules]
        self.rules = [(r, name) for r, name in rules if name is not None]
        keys = key_columns if key_columns is not None else profile.duplicate_keys
        self.keys = [resolve(df, k) or k for k in keys] if keys else list(df.columns)
        # Companions are determined by the profile's own key only; with keys
        # given by the caller they could split groups, so they are not added.
        companions = ([resolve(df, c) for c in profile.grouping_companions]
                      if key_columns is None else [])
        self.group_columns = [c for c in companions if c is not None and c not in self.keys]
        self.group_columns += self.keys
        self.date_column = resolve(df, date_column or profile.date_column)
        self.checks = (("schema",) if expected_schema is not None else ()) + CHECK_ORDER[1:]

    # -- aggregates ------------------------------------------------------------
    # Every metric is decomposable and reads at most one column. ``wide``
    # groups by the duplicate key first: a metric of a key column is constant
    # within a group, so it is derived after the shuffle from the key value
    # and the group's multiplicity; only metrics of non-key columns are
    # aggregated inside the first group-by. With the whole row as the key
    # (the default), the shuffle carries the row and one count, nothing else.
    def completeness_parts(self) -> list[Metric]:
        parts = [Metric("total_rows", None, "rows")]
        parts += [Metric(f"null_{i}", c, "count_if", f"{_q(c)} IS NULL")
                  for i, c in enumerate(self.columns)]
        parts += [Metric(f"empty_{i}", c, "count_if", f"{_q(c)} = ''")
                  for i, c in enumerate(self.columns) if c in self.strings]
        return parts

    def range_parts(self) -> list[Metric]:
        parts = []
        for j, (rule, name) in enumerate(self.rules):
            v = _numeric(self.df, name)
            parts += [Metric(f"min_{j}", name, "min", v), Metric(f"max_{j}", name, "max", v),
                      Metric(f"sum_{j}", name, "sum", v), Metric(f"n_{j}", name, "count", v),
                      Metric(f"below_{j}", name, "count_if", f"{v} < {float(rule.lower)!r}D"),
                      Metric(f"above_{j}", name, "count_if", f"{v} > {float(rule.upper)!r}D")]
        return parts

    def temporal_parts(self) -> list[Metric]:
        if self.date_column is None:
            return []
        c = self.date_column
        ts = _timestamp(self.df, c, self.profile.timestamp_format)
        parts = [Metric("ts_invalid", c, "count_if", f"{ts} IS NULL"),
                 Metric("ts_min", c, "min", ts), Metric("ts_max", c, "max", ts)]
        if self.as_of is not None:
            bound = _ts_literal(self.df.schema[c].dataType, self.as_of)
            parts.append(Metric("ts_future", c, "count_if", f"{ts} > {bound}"))
        return parts

    def parts(self) -> list[Metric]:
        return self.completeness_parts() + self.range_parts() + self.temporal_parts()

    def completeness_aggs(self) -> list[Column]:
        """Single-level aggregates for a plain scan."""
        return _named({m.name: m.aggregate() for m in self.completeness_parts()})

    def range_aggs(self) -> list[Column]:
        means = {f"avg_{j}": f"avg({_numeric(self.df, name)})" for j, (_, name) in enumerate(self.rules)}
        return _named(means | {m.name: m.aggregate() for m in self.range_parts()
                               if not m.name.startswith("sum_")})

    def duplicates_row(self) -> DataFrame:
        per_key = self.df.groupBy(*[F.col(k) for k in self.group_columns]).agg(
            F.count(F.lit(1)).alias("_m"))
        return per_key.agg(F.coalesce(F.sum("_m"), F.lit(0)).cast("long").alias("dup_total"),
                           F.count(F.lit(1)).alias("dup_unique"))

    def wide(self) -> DataFrame:
        """One row with every metric, from one scan and one shuffle.

        Level 1 groups by the duplicate key (map-side partial aggregation
        collapses a hot key before the shuffle) and aggregates only the
        metrics of non-key columns; level 2 derives the key-column metrics
        from (key value, multiplicity), combines the rest and counts the keys.
        """
        parts = self.parts()
        keyset = set(self.group_columns)
        if self.staged is not None and keyset == set(self.df.columns):
            per_key, inner = self.staged.withColumnRenamed("copies", "_m"), []
        else:
            inner = [m for m in parts if m.source is not None and m.source not in keyset]
            per_key = self.df.groupBy(*[_q(k) for k in self.group_columns]).agg(
                *_named({"_m": "count(1)"} | {m.name: m.aggregate() for m in inner}))
        inner_names = {m.name for m in inner}
        combined = per_key.agg(*_named(
            {m.name: m.combine() if m.name in inner_names else m.weighted("_m") for m in parts}
            | {"dup_total": "coalesce(sum(_m), 0L)", "dup_unique": "count(1)"}))
        extra = [f"try_divide(sum_{j}, n_{j}) AS avg_{j}" for j in range(len(self.rules))]
        if self.date_column is not None and self.as_of is None:
            extra.append("0L AS ts_future")
        return combined.selectExpr("*", *extra)

    # -- check definitions as expressions over the wide row ----------------------
    def schema_issues(self) -> list[tuple[str, str, str | None, str | None]]:
        return schema_issues(self.df.schema, self.expected_schema) if self.expected_schema else []

    def duplicate_field(self) -> str:
        return "*" if self.keys == list(self.df.columns) else ",".join(self.keys)

    def rows(self) -> list[tuple[str, str, str, str, str, str]]:
        """(check, field, metric, value, threshold, valid) for every check row;
        the last three are SQL over the wide row."""
        out = []
        if self.expected_schema is not None:
            issues = [i for i in self.schema_issues() if i[1] != "extra"]
            out += [("schema", field, issue, "1.0D", "0.0D", "false") for field, issue, _, _ in issues]
            if not issues:
                out.append(("schema", "*", "issues", "0.0D", "0.0D", "true"))
        limit = f"{float(self.profile.max_null_pct)!r}D"
        for i, c in enumerate(self.columns):
            p = _pct(f"null_{i}", "total_rows")
            out.append(("completeness", c, "null_pct", p, limit, f"NOT ({p} > {limit})"))
        for i, c in enumerate(self.columns):
            if c in self.strings:
                p = _pct(f"empty_{i}", "total_rows")
                out.append(("completeness", c, "empty_pct", p, limit, f"NOT ({p} > {limit})"))
        for j, (rule, name) in enumerate(self.rules):
            out.append(("ranges", name, "below_min", f"below_{j}", f"{float(rule.lower)!r}D", f"below_{j} = 0"))
            out.append(("ranges", name, "above_max", f"above_{j}", f"{float(rule.upper)!r}D", f"above_{j} = 0"))
        dup = _pct("(dup_total - dup_unique)", "dup_total")
        dup_limit = f"{float(self.profile.max_duplicate_pct)!r}D"
        out.append(("duplicates", self.duplicate_field(), "duplicate_pct", dup, dup_limit, f"{dup} <= {dup_limit}"))
        if self.date_column is not None:
            out += [("temporal", self.date_column, metric, col, "0.0D", f"{col} = 0")
                    for metric, col in (("invalid_dates", "ts_invalid"), ("future_dates", "ts_future"))]
        else:
            out.append(("temporal", self.profile.date_column, "missing_column", "0.0D", "0.0D", "true"))
        return out

    def long(self, wide: DataFrame) -> DataFrame:
        """The long-form result generated from the one-row ``wide`` frame."""
        structs = [f"named_struct('check_name', {_text(check)}, 'field', {_text(field)}, 'metric', {_text(metric)}, "
                   f"'metric_value', CAST({value} AS DOUBLE), 'threshold', CAST({threshold} AS DOUBLE), 'valid', {valid})"
                   for check, field, metric, value, threshold, valid in self.rows()]
        return wide.selectExpr(f"inline(array({', '.join(structs)}))")

    def check_valid(self) -> dict[str, Column]:
        """check name -> validity expression over the wide row."""
        by_check: dict[str, list[str]] = {}
        for check, _, _, _, _, valid in self.rows():
            by_check.setdefault(check, []).append(f"coalesce({valid}, false)")
        return {check: F.expr(" AND ".join(by_check.get(check, ["true"]))) for check in self.checks}


def full_validation(df: DataFrame, profile: Profile = READINGS,
                    expected_schema: T.StructType | None = None,
                    as_of: str | datetime | None = None,
                    key_columns: list[str] | None = None, staged: DataFrame | None = None) -> DataFrame:
    """Long-form result of all checks: check_name, field, metric, metric_value,
    threshold, valid (one row per check x field x metric)."""
    plan = QualityPlan(df, profile, expected_schema, as_of, key_columns, staged=staged)
    return plan.long(plan.wide())


def validation_summary(long_df: DataFrame) -> DataFrame:
    """total/passed/failed checks and overall validity of a long-form result."""
    per_check = long_df.groupBy("check_name").agg(F.bool_and("valid").alias("ok"))
    return per_check.agg(
        F.count(F.lit(1)).alias("total_validations"),
        F.count_if(F.col("ok")).alias("passed_validations"),
        F.count_if(~F.col("ok")).alias("failed_validations"),
        F.coalesce(F.bool_and("ok"), F.lit(True)).alias("overall_valid"))


def null_counts(df: DataFrame) -> DataFrame:
    """column_name, null_count for every column, one scan."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return _inline(row, [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"))
                         for i, c in enumerate(df.columns)])


def completeness(df: DataFrame, profile: Profile = READINGS) -> DataFrame:
    """column_name, total_rows, null_count, empty_count (strings only),
    completeness_pct, null_breach, empty_breach (strings only).

    A breach is a null (or empty-string) share strictly above the threshold.
    """
    plan = QualityPlan(df, profile)
    row = df.agg(*plan.completeness_aggs())
    total = F.col("total_rows")
    limit = F.lit(float(profile.max_null_pct))
    structs = []
    for i, c in enumerate(plan.columns):
        nulls = F.col(f"null_{i}")
        if c in plan.strings:
            empties = F.col(f"empty_{i}")
            empty_breach = pct(empties, total) > limit
        else:
            empties = F.lit(None).cast("long")
            empty_breach = F.lit(None).cast("boolean")
        structs.append(F.struct(
            F.lit(c).alias("column_name"), total.alias("total_rows"), nulls.alias("null_count"),
            empties.alias("empty_count"), (F.lit(100.0) - pct(nulls, total)).alias("completeness_pct"),
            (pct(nulls, total) > limit).alias("null_breach"), empty_breach.alias("empty_breach")))
    return _inline(row, structs)


def _range_row(df: DataFrame, profile: Profile) -> tuple[QualityPlan, DataFrame]:
    plan = QualityPlan(df, profile)
    return plan, df.agg(F.count(F.lit(1)).alias("total_rows"), *plan.range_aggs())


def range_stats(df: DataFrame, profile: Profile = READINGS) -> DataFrame:
    """field, min_value, max_value, avg_value, n_values per range-rule field."""
    plan, row = _range_row(df, profile)
    return _inline(row, [F.struct(F.lit(name).alias("field"),
                                  F.col(f"min_{j}").cast("double").alias("min_value"),
                                  F.col(f"max_{j}").cast("double").alias("max_value"),
                                  F.col(f"avg_{j}").alias("avg_value"),
                                  F.col(f"n_{j}").alias("n_values"))
                         for j, (_, name) in enumerate(plan.rules)])


def range_violations(df: DataFrame, profile: Profile = READINGS) -> DataFrame:
    """field, lower_bound, upper_bound, min_violations, max_violations, valid.

    Bounds are inclusive, nulls never violate; NaN compares above every number
    and so counts as above the maximum.
    """
    plan, row = _range_row(df, profile)
    return _inline(row, [F.struct(F.lit(name).alias("field"),
                                  F.lit(float(rule.lower)).alias("lower_bound"),
                                  F.lit(float(rule.upper)).alias("upper_bound"),
                                  F.col(f"below_{j}").alias("min_violations"),
                                  F.col(f"above_{j}").alias("max_violations"),
                                  ((F.col(f"below_{j}") + F.col(f"above_{j}")) == 0).alias("valid"))
                         for j, (rule, name) in enumerate(plan.rules)])


def duplicates(df: DataFrame, key_columns: list[str] | None = None,
               profile: Profile = READINGS) -> DataFrame:
    """total_rows, unique_rows, duplicate_count, duplicate_pct, valid.

    One shuffle: count per key (partial aggregation first), then a global sum.
    """
    plan = QualityPlan(df, profile, key_columns=key_columns)
    dup = F.col("dup_total") - F.col("dup_unique")
    p = pct(dup, F.col("dup_total"))
    return plan.duplicates_row().select(
        F.col("dup_total").alias("total_rows"), F.col("dup_unique").alias("unique_rows"),
        dup.alias("duplicate_count"), p.alias("duplicate_pct"),
        (p <= F.lit(float(profile.max_duplicate_pct))).alias("valid"))


def temporal_check(df: DataFrame, date_column: str, as_of: str | datetime,
                   profile: Profile = READINGS) -> DataFrame:
    """total_rows, invalid_dates (unparseable or null), future_dates (after
    ``as_of``), min_ts, max_ts, valid. ``as_of`` is explicit, so the result
    is reproducible."""
    name = resolve(df, date_column)
    if name is None:
        raise ValueError(f"date column {date_column!r} not found")
    ts = as_timestamp(df, name, profile.timestamp_format)
    bound = F.expr(_ts_literal(df.schema[name].dataType, as_of))
    row = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 F.count_if(ts.isNull()).alias("invalid_dates"),
                 F.count_if(ts > bound).alias("future_dates"),
                 F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))
    return row.withColumn("valid", (F.col("invalid_dates") == 0) & (F.col("future_dates") == 0))


def temporal_gaps(df: DataFrame, date_column: str) -> DataFrame:
    """Runs of calendar days with no row: gap_start, gap_end, missing_days.

    Distinct days and years are bounded by the calendar span, not by the data
    volume.
    """
    name = resolve(df, date_column)
    if name is None:
        raise ValueError(f"date column {date_column!r} not found")
    # One scan: each task sends one row per day; a year's days (at most 366) are
    # one sorted array. What the array of a year lacks is the step to the next
    # year that has days: those steps come from the years' first and last days,
    # one row per year of data.
    days = df.select(F.to_date(F.col(name)).alias("d")).where(F.col("d").isNotNull()).distinct()
    years = (days.groupBy(F.year("d").alias("y"))
             .agg(F.array_sort(F.collect_list("d")).alias("days")))
    # Every year offers its own steps, and itself to the century's summary of ends.
    steps = F.zip_with(F.slice("days", 1, F.greatest(F.size("days") - 1, F.lit(0))),
                       F.slice("days", 2, F.greatest(F.size("days") - 1, F.lit(0))),
                       lambda a, b: F.struct(a.alias("d"), b.alias("nxt")))
    ends = F.array(F.struct(F.element_at("days", 1).alias("d"), F.element_at("days", -1).alias("nxt")))
    rows = years.select(F.inline(F.concat(
        F.transform(F.filter(steps, lambda s: F.datediff(s["nxt"], s["d"]) > 1),
                    lambda s: F.struct(F.lit(False).alias("end"), s["d"].alias("d"), s["nxt"].alias("nxt"))),
        F.transform(ends, lambda s: F.struct(F.lit(True).alias("end"), s["d"].alias("d"), s["nxt"].alias("nxt"))))))
    # (first, last) of the years in one sorted array: a row per year of the calendar.
    merged = rows.groupBy("end").agg(F.array_sort(F.collect_list(F.struct("d", "nxt"))).alias("s"))
    across = F.zip_with(F.slice("s", 1, F.greatest(F.size("s") - 1, F.lit(0))),
                        F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0))),
                        lambda a, b: F.struct(a["nxt"].alias("d"), b["d"].alias("nxt")))
    linked = merged.select(F.inline(F.when(F.col("end"), across).otherwise(F.col("s"))))
    step = F.datediff(F.col("nxt"), F.col("d"))
    return linked.where(step > 1).select(
        F.date_add(F.col("d"), 1).alias("gap_start"),
        F.date_sub(F.col("nxt"), 1).alias("gap_end"),
        (step - 1).cast("long").alias("missing_days"))


def schema_issues(actual: T.StructType, expected: T.StructType):
    """(field, issue, expected_type, actual_type); issue is missing, type or extra.

    Names are compared exactly; nullability and order are ignored.
    """
    have = {f.name: f.dataType for f in actual.fields}
    want = {f.name: f.dataType for f in expected.fields}
    out = []
    for f in expected.fields:
        if f.name not in have:
            out.append((f.name, "missing", f.dataType.simpleString(), None))
        elif have[f.name] != f.dataType:
            out.append((f.name, "type", f.dataType.simpleString(), have[f.name].simpleString()))
    for f in actual.fields:
        if f.name not in want:
            out.append((f.name, "extra", None, f.dataType.simpleString()))
    return out


def schema_check(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Schema comparison with what it concerns: field, issue, expected_type,
    actual_type, n_rows, n_values (of the field as it is; 0 if missing). One scan."""
    issues = schema_issues(df.schema, expected)
    present = [f for f, issue, _, _ in issues if issue != "missing"]
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{f}`")).alias(f"v{i}") for i, f in enumerate(present)])
    none = F.lit(None).cast("string")
    structs = [F.struct(F.lit(f).alias("field"), F.lit(issue).alias("issue"),
                        (F.lit(want) if want else none).alias("expected_type"),
                        (F.lit(have) if have else none).alias("actual_type"), F.col("n").alias("n_rows"),
                        (F.col(f"v{present.index(f)}") if f in present else F.lit(0).cast("long")).alias("n_values"))
               for f, issue, want, have in issues]
    kind = "array<struct<field:string,issue:string,expected_type:string,actual_type:string,n_rows:bigint,n_values:bigint>>"
    return row.select(F.inline(F.array(*structs).cast(kind)))


def stage_quality_metrics(df: DataFrame, profile: Profile = READINGS) -> DataFrame:
    """Quality counts after each cleaning stage: stage, total_rows, valid_rows,
    null_rows, duplicate_rows, invalid_rows, valid_pct.

    valid_rows = total - null - duplicate - invalid (overlapping defects are
    counted once per rule, as a stage log does). All four stages come from
    one group-by over the whole row.
    """
    cols = df.columns
    critical = [c for c in (resolve(df, n) for n in profile.critical_columns) if c]
    inv = invalid_condition(df, profile)
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m")).select(
        "_m", any_null(critical).alias("_null"),
        (inv if inv is not None else F.lit(False)).alias("_inv"))
    m, nf, iv = F.col("_m"), F.col("_null"), F.col("_inv")
    z = F.lit(0).cast("long")

    def weighted(cond):
        return F.coalesce(F.sum(F.when(cond, m)), z)
    row = g.agg(
        F.coalesce(F.sum(m), z).alias("raw_total"), weighted(nf).alias("raw_null"),
        weighted(iv).alias("raw_inv"), F.count(F.lit(1)).alias("dd_total"),
        F.count_if(nf).alias("dd_null"), F.count_if(iv).alias("dd_inv"),
        F.count_if(~nf).alias("nn_total"), F.count_if(~nf & iv).alias("nn_inv"),
        F.count_if(~nf & ~iv).alias("cl_total"))

    def stage(name, total, nulls, dups, invalid):
        valid = total - nulls - dups - invalid
        return F.struct(F.lit(name).alias("stage"), total.alias("total_rows"),
                        valid.alias("valid_rows"), nulls.alias("null_rows"),
                        dups.alias("duplicate_rows"), invalid.alias("invalid_rows"),
                        pct(valid, total).alias("valid_pct"))
    c = F.col
    return _inline(row, [
        stage("raw", c("raw_total"), c("raw_null"), c("raw_total") - c("dd_total"), c("raw_inv")),
        stage("deduplicated", c("dd_total"), c("dd_null"), z, c("dd_inv")),
        stage("non_null", c("nn_total"), z, z, c("nn_inv")),
        stage("cleaned", c("cl_total"), z, z, z),
    ])


def quarantine_rows(df: DataFrame, profile: Profile = READINGS,
                    staged: DataFrame | None = None) -> DataFrame:
    """Rows the cleaning rejects: one row per distinct row and reason, with
    ``copies``, the number of input rows it stands for.

    Order of rules: extra copies of an exact duplicate ('duplicate'), then a
    null critical column ('null_critical'), then an invalid pressure reading
    ('invalid_pressure'). Cleaned rows + sum(copies) = input rows. One scan and
    one group-by on the row (``staged``, if it is there already); a row repeated
    billions of times stays one row.
    """
    cols = df.columns
    critical = [c for c in (resolve(df, n) for n in profile.critical_columns) if c]
    inv = invalid_condition(df, profile)
    bad = inv if inv is not None else F.lit(False)
    rule = F.when(any_null(critical), F.lit("null_critical")).when(bad, F.lit("invalid_pressure"))
    found = (staged_rows(df) if staged is None else staged).withColumnRenamed("copies", "_m")
    reasons = F.array(F.struct(F.lit("duplicate").alias("reason"), (F.col("_m") - 1).alias("copies")),
                      F.struct(rule.alias("reason"), F.lit(1).cast("long").alias("copies")))
    return (found.select(*cols, F.inline(F.filter(reasons, lambda r: r["reason"].isNotNull() & (r["copies"] > 0)))))
