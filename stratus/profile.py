"""Profiles: the thresholds, column names and rules the operators are given.

A Profile is a small frozen value passed explicitly to every operator; there
is no global configuration.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------
# Raw sensor column -> standard name. The first ten entries are the
# reference's rename map; "Humidity" and "Summary" are added so that every
# measured column is standardised (the reference left humidity unrenamed and
# therefore never produced avg_humidity).
RENAME_MAP = {
    "Temperature (C)": "temperatureC",
    "Apparent Temperature (C)": "apparent_temperatureC",
    "Wind Speed (km/h)": "wind_speed_kmh",
    "Wind Bearing (degrees)": "wind_bearing_degrees",
    "Visibility (km)": "visibility_km",
    "Loud Cover": "cloud_cover",
    "Pressure (millibars)": "pressure_millibars",
    "Precip Type": "precipitation_type",
    "Daily Summary": "daily_summary",
    "Formatted Date": "formatted_date",
    "Humidity": "humidity",
    "Summary": "summary",
}
# Quality thresholds and physical bounds.
MAX_NULL_PCT = 10.0          # completeness breach when null % is strictly above
MAX_DUPLICATE_PCT = 10.0     # duplicate check passes when duplicate % is at most
TEMPERATURE_RANGE = (-50.0, 60.0)
HUMIDITY_RANGE = (0.0, 1.0)
WIND_SPEED_RANGE = (0.0, 200.0)
PRESSURE_RANGE = (800.0, 1100.0)
# Timestamp text pattern of the raw CSV readings.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS Z"
# Daily aggregate: metric column -> output name, in output order.
DAILY_METRICS = (
    ("humidity", "avg_humidity"),
    ("wind_speed_kmh", "avg_wind_speed"),
    ("pressure_millibars", "avg_pressure"),
    ("visibility_km", "avg_visibility"),
)
# Season of each month number.
SEASONS = (("Winter", (12, 1, 2)), ("Spring", (3, 4, 5)), ("Summer", (6, 7, 8)))
SEASON_OTHERWISE = "Fall"
# Weekend days as numbered by dayofweek (1 = Sunday ... 7 = Saturday).
WEEKEND_DAYS = (1, 7)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RangeRule:
    """Inclusive bounds for one logical field; nulls never violate."""

    field: str
    lower: float
    upper: float


@dataclass(frozen=True)
class Profile:
    date_column: str = "formatted_date"
    temperature_column: str = "temperatureC"
    pressure_column: str = "pressure_millibars"
    critical_columns: tuple[str, ...] = ("formatted_date", "temperatureC")
    pressure_min: float = PRESSURE_RANGE[0]
    # "drop": a null pressure fails the validity rule; "keep": it passes.
    null_policy: str = "drop"
    range_rules: tuple[RangeRule, ...] = ()
    max_null_pct: float = MAX_NULL_PCT
    max_duplicate_pct: float = MAX_DUPLICATE_PCT
    # Columns whose nulls are expected (e.g. lag features) and are not checked.
    completeness_exempt: tuple[str, ...] = ()
    duplicate_keys: tuple[str, ...] | None = None
    # Columns determined by the duplicate key (e.g. year and month of a date
    # key). They are grouped with the key, which forms the same groups, so a
    # frame already partitioned by them (a month-scoped window's output) is
    # aggregated without a new exchange.
    grouping_companions: tuple[str, ...] = ()
    timestamp_format: str = TIMESTAMP_FORMAT
    rename_map: dict = field(default_factory=lambda: dict(RENAME_MAP))

    def with_(self, **changes) -> "Profile":
        return replace(self, **changes)


READINGS = Profile(
    range_rules=(
        RangeRule("temperatureC", *TEMPERATURE_RANGE),
        RangeRule("humidity", *HUMIDITY_RANGE),
        RangeRule("wind_speed_kmh", *WIND_SPEED_RANGE),
        RangeRule("pressure_millibars", *PRESSURE_RANGE),
    ),
)

# Profile for the daily feature frame: rules bound to the aggregated names,
# lag columns exempt from completeness (they are null by construction on the
# first rows of every month), one row per date expected.
FEATURES = Profile(
    date_column="date",
    temperature_column="avg_tempC",
    critical_columns=("date",),
    range_rules=(
        RangeRule("avg_tempC", *TEMPERATURE_RANGE),
        RangeRule("min_tempC", *TEMPERATURE_RANGE),
        RangeRule("max_tempC", *TEMPERATURE_RANGE),
        RangeRule("avg_humidity", *HUMIDITY_RANGE),
        RangeRule("avg_wind_speed", *WIND_SPEED_RANGE),
        RangeRule("avg_pressure", *PRESSURE_RANGE),
    ),
    completeness_exempt=("std_tempC", "temp_7d_std", "temp_change_1d", "temp_change_7d"),
    duplicate_keys=("date",),
    grouping_companions=("year", "month"),
)
