"""DataFrame -> DataFrame operators. None of them triggers an action
(``policy.apply_policy`` runs one validation query unless it quarantines)."""

from stratus.operators.clean import (
    clean_readings,
    dedup_exact,
    drop_critical_nulls,
    filter_invalid,
    invalid_condition,
    staged_rows,
    standardize_columns,
)
from stratus.operators.daily import daily_agg
from stratus.operators.features import (
    calendar_features,
    daily_features,
    lag_features,
    rolling_features,
)

__all__ = ["clean_readings", "dedup_exact", "drop_critical_nulls", "filter_invalid",
           "invalid_condition", "staged_rows", "standardize_columns", "daily_agg", "calendar_features",
           "daily_features", "lag_features", "rolling_features"]
