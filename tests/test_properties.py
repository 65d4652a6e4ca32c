"""Randomised properties of the bucket and the rounding against plain-Python references."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from plantlake.functions import bucket_start, day_of, stable_round

TIMESTAMPS = st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2200, 12, 31))
SETTINGS = settings(
    max_examples=25, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def floor_to(ts: dt.datetime, minutes: int) -> dt.datetime:
    return ts.replace(minute=ts.minute - ts.minute % minutes, second=0, microsecond=0)


@SETTINGS
@given(st.lists(TIMESTAMPS, min_size=1, max_size=40), st.sampled_from([1, 5, 10, 15, 20, 30, 60]))
def test_bucket_is_floor_within_the_hour(spark, stamps, minutes):
    schema = T.StructType([T.StructField("ts", T.TimestampNTZType())])
    df = spark.createDataFrame([(t,) for t in stamps], schema)
    rows = df.select("ts", bucket_start("ts", minutes).alias("b"), day_of("ts").alias("d")).collect()
    for r in rows:
        assert r.b == floor_to(r.ts, minutes)
        assert r.d == r.ts.date()


def half_up(x: float, digits: int) -> float:
    six = Decimal(repr(x)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
    return float(six.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


@SETTINGS
@given(
    st.lists(
        st.floats(min_value=-1e9, max_value=1e9, allow_nan=False, allow_infinity=False)
        | st.integers(-10**6, 10**6).map(lambda i: i / 20),  # many exact ties like 0.05, 2.45
        min_size=1,
        max_size=40,
    ),
    st.integers(0, 3),
)
def test_stable_round_is_half_up_on_six_decimals(spark, values, digits):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r.r for r in df.select(stable_round("x", digits).alias("r")).collect()]
    assert got == [half_up(float(v), digits) for v in values]
