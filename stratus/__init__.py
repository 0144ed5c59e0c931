"""stratus: lazily composed PySpark operators for timestamped sensor readings.

Every operator takes and returns a ``DataFrame`` and triggers no action, so a
whole job (scan -> clean -> daily aggregate -> features -> quality -> sink) is
one logical plan that Catalyst optimises end to end.
"""

from stratus.profile import FEATURES, READINGS, Profile, RangeRule

__all__ = ["Profile", "RangeRule", "READINGS", "FEATURES"]
