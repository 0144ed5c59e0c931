"""Randomised checks of the quality metrics on frames with many duplicates,
nulls, NaN and empty strings (values drawn from small pools)."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratus.operators import quality
from stratus.operators.clean import clean_readings
from stratus.profile import READINGS
from tests.fixtures import READING_SCHEMA

TS = [dt.datetime(2020, 1, 1), dt.datetime(2031, 5, 1), None]
NUM = [-60.0, 0.0, 0.5, 2.0, 900.0, 1200.0, float("nan"), None]

row = st.tuples(st.sampled_from([1, 2, None]), st.sampled_from(TS), st.sampled_from(["", "a", None]),
                *[st.sampled_from(NUM) for _ in range(5)])
frames = st.lists(row, min_size=0, max_size=25)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _long(df, keys):
    return {(x.check_name, x.field, x.metric): (x.metric_value, x.valid)
            for x in quality.full_validation(df, READINGS, None, "2030-01-01 00:00:00", keys).collect()
            if x.check_name != "duplicates"}


def _same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        (va, oka), (vb, okb) = a[k], b[k]
        assert oka == okb and (va == vb or (math.isnan(va) and math.isnan(vb))), k


@SETTINGS
@given(frames)
def test_multiplicity_metrics_equal_grouped_metrics(spark, rows):
    df = spark.createDataFrame(rows, READING_SCHEMA)
    whole = _long(df, None)
    _same(whole, _long(df, ["reading_id"]))
    _same(whole, _long(df, ["summary", "humidity"]))
    n = len(rows)
    nulls = sum(1 for r in rows if r[3] is None)
    expect = 100.0 * nulls / n if n else 0.0
    assert math.isclose(whole[("completeness", "temperatureC", "null_pct")][0], expect)


@SETTINGS
@given(frames)
def test_quarantine_plus_clean_is_input(spark, rows):
    df = spark.createDataFrame(rows, READING_SCHEMA)
    rejected = sum(r.copies for r in quality.quarantine_rows(df).collect())
    assert rejected + clean_readings(df).count() == len(rows)
