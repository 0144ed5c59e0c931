"""Oracle SQL (DuckDB dialect) for the catalog keys.

The texts are built from named common table expressions that mirror the
Spark operators one to one: R (readings view), C (cleaned), D (daily), F
(features). Inexact outputs are rounded to 6 places on both sides; exact ones
(counts, min/max, sums of dyadic values) are compared unrounded.
"""

from __future__ import annotations

CTE = {}

CTE["R_base"] = """R_base AS (
  SELECT l_orderkey AS reading_id,
         CASE WHEN l_linenumber = 3 AND l_orderkey % 16 = 0 THEN NULL ELSE l_shipdate END AS formatted_date,
         CASE WHEN l_linenumber = 4 AND l_quantity < 10 THEN ''
              WHEN l_linenumber = 2 THEN NULL ELSE l_returnflag END AS summary,
         CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity * 2.5e0 - 60e0 END AS temperatureC,
         CASE WHEN l_linenumber = 4 AND l_orderkey % 4 = 1 THEN NULL
              ELSE round(l_discount * 100e0) * 0.109375e0 END AS humidity,
         round(l_tax * 100e0) * 28.5e0 AS wind_speed_kmh,
         CASE WHEN l_linenumber = 7 THEN 0e0 WHEN l_linenumber = 1 AND l_orderkey % 8 = 0 THEN 640.5e0 WHEN l_linenumber = 5 THEN NULL
              ELSE 900e0 + floor(l_extendedprice / 500e0) END AS pressure_millibars,
         l_quantity * 0.25e0 AS visibility_km
  FROM lineitem)"""

CTE["R"] = """R AS (
  SELECT * FROM R_base
  UNION ALL
  SELECT * FROM R_base WHERE reading_id % 10 = 0)"""

VALID_PRESSURE = "(pressure_millibars > 0e0 AND pressure_millibars >= 800e0)"
CRITICAL_OK = "(formatted_date IS NOT NULL AND temperatureC IS NOT NULL)"

CTE["C"] = f"""C AS (
  SELECT DISTINCT * FROM R
  WHERE {CRITICAL_OK} AND {VALID_PRESSURE})"""

CTE["D"] = """D AS (
  SELECT CAST(formatted_date AS DATE) AS date,
         count(*) AS n_rows,
         CAST(count(DISTINCT CAST(formatted_date AS DATE)) AS BIGINT) AS unique_days,
         avg(temperatureC) AS avg_tempC,
         max(temperatureC) AS max_tempC,
         min(temperatureC) AS min_tempC,
         stddev_samp(temperatureC) AS std_tempC,
         avg(humidity) AS avg_humidity,
         avg(wind_speed_kmh) AS avg_wind_speed,
         avg(pressure_millibars) AS avg_pressure,
         avg(visibility_km) AS avg_visibility
  FROM C
  GROUP BY CAST(formatted_date AS DATE))"""

CTE["F"] = """F AS (
  SELECT *,
         CAST(year(date) AS INTEGER) AS year,
         CAST(month(date) AS INTEGER) AS month,
         CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
         CAST(quarter(date) AS INTEGER) AS quarter,
         avg(avg_tempC) OVER w7 AS temp_7d_avg,
         avg(avg_tempC) OVER w30 AS temp_30d_avg,
         stddev_samp(avg_tempC) OVER w7 AS temp_7d_std,
         min(avg_tempC) OVER w7 AS temp_7d_min,
         max(avg_tempC) OVER w7 AS temp_7d_max,
         avg_tempC - lag(avg_tempC, 1) OVER wl AS temp_change_1d,
         avg_tempC - lag(avg_tempC, 7) OVER wl AS temp_change_7d,
         CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter'
              WHEN month(date) IN (3, 4, 5) THEN 'Spring'
              WHEN month(date) IN (6, 7, 8) THEN 'Summer'
              ELSE 'Fall' END AS season
  FROM D
  WINDOW wl AS (PARTITION BY year(date), month(date) ORDER BY date),
         w7 AS (PARTITION BY year(date), month(date) ORDER BY date
                ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w30 AS (PARTITION BY year(date), month(date) ORDER BY date
                 ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))"""

CTE["T"] = """T AS (
  SELECT *, CASE reading_id % 8 WHEN 0 THEN 'two' || chr(10) || 'lines' WHEN 1 THEN 'say "hi", they'
              WHEN 2 THEN 'back' || chr(92) || 'slash ' || chr(92) || 'n' WHEN 3 THEN ''
              WHEN 5 THEN '  padded, comma ' WHEN 6 THEN 'cr' || chr(13) || chr(10) || 'lf'
              WHEN 7 THEN 'ünï – 漢' END AS note,
         formatted_date + to_microseconds(reading_id) AS seen_at
  FROM R)"""

# Dependencies between the CTEs, so a query names only what it reads.
DEPS = {"R_base": (), "R": ("R_base",), "T": ("R",), "C": ("R",), "D": ("C",), "F": ("D",)}


def _closure(names) -> list[str]:
    order: list[str] = []

    def visit(n):
        for d in DEPS.get(n, ()):
            visit(d)
        if n not in order:
            order.append(n)
    for n in names:
        visit(n)
    return order


def sql(body: str, *ctes: str, extra: tuple[str, ...] = ()) -> str:
    """``WITH <ctes in dependency order>, <extra> <body>``."""
    parts = [CTE[n] for n in _closure(ctes)] + list(extra)
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


READINGS_COLUMNS = ("reading_id, formatted_date, summary, temperatureC, humidity, "
                    "wind_speed_kmh, pressure_millibars, visibility_km")

DAILY_SELECT = ("date, n_rows, unique_days, avg_tempC, max_tempC, min_tempC, "
                "round(std_tempC, 6) AS std_tempC, avg_humidity, avg_wind_speed, "
                "avg_pressure, avg_visibility")

FEATURES_SELECT = (DAILY_SELECT + ", year, month, day_of_week, quarter, "
                   "round(temp_7d_avg, 6) AS temp_7d_avg, round(temp_30d_avg, 6) AS temp_30d_avg, "
                   "round(temp_7d_std, 6) AS temp_7d_std, temp_7d_min, temp_7d_max, "
                   "temp_change_1d, temp_change_7d, is_weekend, season")


# ---------------------------------------------------------------------------
# Generic generators for the quality keys. ``cols`` are (name, kind) pairs with
# kind in {num, str, ts, date}; ``rules`` are (field, lower, upper).
# ---------------------------------------------------------------------------

R_COLS = [("reading_id", "num"), ("formatted_date", "ts"), ("summary", "str"),
          ("temperatureC", "num"), ("humidity", "num"), ("wind_speed_kmh", "num"),
          ("pressure_millibars", "num"), ("visibility_km", "num")]
R_RULES = [("temperatureC", -50.0, 60.0), ("humidity", 0.0, 1.0),
           ("wind_speed_kmh", 0.0, 200.0), ("pressure_millibars", 800.0, 1100.0)]

F_COLS = [("date", "date"), ("n_rows", "num"), ("unique_days", "num"), ("avg_tempC", "num"),
          ("max_tempC", "num"), ("min_tempC", "num"), ("std_tempC", "num"),
          ("avg_humidity", "num"), ("avg_wind_speed", "num"), ("avg_pressure", "num"),
          ("avg_visibility", "num"), ("year", "num"), ("month", "num"), ("day_of_week", "num"),
          ("quarter", "num"), ("temp_7d_avg", "num"), ("temp_30d_avg", "num"),
          ("temp_7d_std", "num"), ("temp_7d_min", "num"), ("temp_7d_max", "num"),
          ("temp_change_1d", "num"), ("temp_change_7d", "num"), ("is_weekend", "num"),
          ("season", "str")]
F_EXEMPT = ("std_tempC", "temp_7d_std", "temp_change_1d", "temp_change_7d")
F_RULES = [("avg_tempC", -50.0, 60.0), ("min_tempC", -50.0, 60.0), ("max_tempC", -50.0, 60.0),
           ("avg_humidity", 0.0, 1.0), ("avg_wind_speed", 0.0, 200.0),
           ("avg_pressure", 800.0, 1100.0)]


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def pct(part: str, total: str) -> str:
    return f"(CASE WHEN {total} > 0 THEN 100e0 * ({part}) / {total} ELSE 0e0 END)"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ts_expr(name: str, kind: str) -> str:
    return f"CAST({q(name)} AS TIMESTAMP)" if kind == "date" else q(name)


class QualitySQL:
    """SQL twin of ``stratus.operators.quality.QualityPlan``."""

    def __init__(self, src: str, cols, rules, keys=None, date_col=None, as_of=None,
                 exempt=(), schema_rows=None, max_null_pct=10.0, max_dup_pct=10.0):
        self.src = src
        self.all_cols = [c for c, _ in cols]
        self.cols = [(c, k) for c, k in cols if c not in exempt]
        self.rules = rules
        self.keys = keys or self.all_cols
        self.date_col = date_col
        self.date_kind = dict(cols).get(date_col)
        self.as_of = as_of
        self.schema_rows = schema_rows
        self.max_null = max_null_pct
        self.max_dup = max_dup_pct
        self.checks = (["schema"] if schema_rows is not None else []) + [
            "completeness", "ranges", "duplicates", "temporal"]

    def ctes(self) -> list[str]:
        aggs = ["count(*) AS total_rows"]
        aggs += [f"count(*) FILTER (WHERE {q(c)} IS NULL) AS null_{i}"
                 for i, (c, _) in enumerate(self.cols)]
        aggs += [f"count(*) FILTER (WHERE {q(c)} = '') AS empty_{i}"
                 for i, (c, k) in enumerate(self.cols) if k == "str"]
        for j, (f, lo, hi) in enumerate(self.rules):
            aggs += [f"min({q(f)}) AS min_{j}", f"max({q(f)}) AS max_{j}",
                     f"avg({q(f)}) AS avg_{j}", f"count({q(f)}) AS n_{j}",
                     f"count(*) FILTER (WHERE {q(f)} < {dbl(lo)}) AS below_{j}",
                     f"count(*) FILTER (WHERE {q(f)} > {dbl(hi)}) AS above_{j}"]
        if self.date_col:
            t = ts_expr(self.date_col, self.date_kind)
            aggs += [f"count(*) FILTER (WHERE {t} IS NULL) AS ts_invalid",
                     f"min({t}) AS ts_min", f"max({t}) AS ts_max",
                     (f"count(*) FILTER (WHERE {t} > TIMESTAMP {lit(self.as_of)}) AS ts_future"
                      if self.as_of else "CAST(0 AS BIGINT) AS ts_future")]
        keys = ", ".join(q(k) for k in self.keys)
        return [
            f"W AS (SELECT {', '.join(aggs)} FROM {self.src})",
            f"DUP AS (SELECT CAST(coalesce(sum(_m), 0) AS BIGINT) AS dup_total, "
            f"count(*) AS dup_unique FROM (SELECT count(*) AS _m FROM {self.src} GROUP BY {keys}) g)",
            "WD AS (SELECT * FROM W, DUP)",
        ]

    def rows(self):
        """(check, field, metric, value_sql, threshold_sql, valid_sql)."""
        out = []
        if self.schema_rows is not None:
            issues = [r for r in self.schema_rows if r[1] != "extra"]
            for field, issue, _, _ in issues:
                out.append(("schema", field, issue, "1e0", "0e0", "false"))
            if not issues:
                out.append(("schema", "*", "issues", "0e0", "0e0", "true"))
        for i, (c, _) in enumerate(self.cols):
            p = pct(f"null_{i}", "total_rows")
            out.append(("completeness", c, "null_pct", p, dbl(self.max_null),
                        f"NOT ({p} > {dbl(self.max_null)})"))
        for i, (c, k) in enumerate(self.cols):
            if k == "str":
                p = pct(f"empty_{i}", "total_rows")
                out.append(("completeness", c, "empty_pct", p, dbl(self.max_null),
                            f"NOT ({p} > {dbl(self.max_null)})"))
        for j, (f, lo, hi) in enumerate(self.rules):
            out.append(("ranges", f, "below_min", f"below_{j}", dbl(lo), f"below_{j} = 0"))
            out.append(("ranges", f, "above_max", f"above_{j}", dbl(hi), f"above_{j} = 0"))
        p = pct("dup_total - dup_unique", "dup_total")
        field = "*" if list(self.keys) == self.all_cols else ",".join(self.keys)
        out.append(("duplicates", field, "duplicate_pct", p, dbl(self.max_dup),
                    f"{p} <= {dbl(self.max_dup)}"))
        if self.date_col:
            out.append(("temporal", self.date_col, "invalid_dates", "ts_invalid", "0e0",
                        "ts_invalid = 0"))
            out.append(("temporal", self.date_col, "future_dates", "ts_future", "0e0",
                        "ts_future = 0"))
        return out

    def long_body(self) -> str:
        parts = [f"SELECT {lit(c)} AS check_name, {lit(f)} AS field, {lit(m)} AS metric, "
                 f"CAST({v} AS DOUBLE) AS metric_value, CAST({t} AS DOUBLE) AS threshold, "
                 f"({ok}) AS valid FROM WD"
                 for c, f, m, v, t, ok in self.rows()]
        return "\nUNION ALL\n".join(parts)

    def check_valid(self) -> dict[str, str]:
        by = {}
        for c, _, _, _, _, ok in self.rows():
            by.setdefault(c, []).append(f"coalesce({ok}, false)")
        return {c: " AND ".join(by.get(c, ["true"])) for c in self.checks}

    def report_body(self) -> str:
        valid = self.check_valid()
        status = {c: f"CASE WHEN {v} THEN 'PASSED' ELSE 'FAILED' END" for c, v in valid.items()}
        overall = " AND ".join(f"({v})" for v in valid.values())
        passed = " + ".join(f"CASE WHEN {v} THEN 1 ELSE 0 END" for v in valid.values())

        def pct_text(part, total, scale, empty):
            unit = 10 ** scale
            qq = (f"(CASE WHEN {total} > 0 THEN (200 * {unit} * ({part}) + {total}) // (2 * {total}) "
                  f"ELSE {empty * unit} END)")
            return (f"CAST({qq} // {unit} AS VARCHAR) || '.' || "
                    f"lpad(CAST({qq} % {unit} AS VARCHAR), {scale}, '0')")
        lines = [lit("=" * 60), lit("DATA QUALITY REPORT"), lit("=" * 60),
                 f"'Overall Status: ' || CASE WHEN {overall} THEN 'PASSED' ELSE 'FAILED' END",
                 f"'Validations Passed: ' || CAST({passed} AS VARCHAR) || '/{len(self.checks)}'",
                 "''", lit("DETAILED RESULTS:"), lit("-" * 40)]
        for check in self.checks:
            lines += ["''", f"{lit(check.upper() + ': ')} || {status[check]}"]
            if check == "schema":
                n = len([r for r in self.schema_rows if r[1] != "extra"])
                lines.append(lit(f"  Issues: {n}"))
            elif check == "completeness":
                lines.append("'  Total Rows: ' || format('{:,}', total_rows)")
                for i, (c, _) in enumerate(self.cols):
                    lines.append(f"{lit('  ' + c + ': ')} || "
                                 f"{pct_text(f'total_rows - null_{i}', 'total_rows', 1, 100)}"
                                 f" || '% complete'")
            elif check == "ranges":
                for j, (f, _, _) in enumerate(self.rules):
                    lines.append(f"{lit('  ' + f + ': min=')} || coalesce(printf('%.6f', min_{j}), 'N/A')"
                                 f" || ', max=' || coalesce(printf('%.6f', max_{j}), 'N/A')")
            elif check == "duplicates":
                lines.append("'  Duplicate Percentage: ' || "
                             f"{pct_text('dup_total - dup_unique', 'dup_total', 2, 0)} || '%'")
            elif check == "temporal":
                lines.append("'  Date Range: ' || coalesce(CAST(ts_min AS VARCHAR), 'N/A') || ' to ' "
                             "|| coalesce(CAST(ts_max AS VARCHAR), 'N/A')")
                lines.append("'  Invalid Dates: ' || CAST(ts_invalid AS VARCHAR) || "
                             "', Future Dates: ' || CAST(ts_future AS VARCHAR)")
        lines += ["''", lit("=" * 60), lit(f"Report as of: {self.as_of or 'unspecified'}")]
        return "\nUNION ALL\n".join(f"SELECT {n} AS line_no, {line} AS line FROM WD"
                                    for n, line in enumerate(lines, start=1))


def union_rows(select_rows: list[str]) -> str:
    return "\nUNION ALL\n".join(select_rows)
