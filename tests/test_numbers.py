import math
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiermill.functions.numbers import is_number
from tiermill.operators.averages import group_averages
from tiermill.operators.columns import cast_columns, keep_numeric

ACCEPTED = ["180", "180.5", " 180 ", "1e3", "180d", "180f", "NaN", "inf", "Infinity", "-3"]
REJECTED = ["na", "", "75-80", "1,80", "1_000", None]


def test_what_counts_as_a_number(spark):
    df = spark.createDataFrame([(t,) for t in ACCEPTED + REJECTED], "t string")
    assert [r.t for r in df.filter(is_number(F.col("t"))).collect()] == ACCEPTED
    finite = [r.t for r in df.filter(is_number(F.col("t"), finite_only=True)).collect()]
    assert finite == [t for t in ACCEPTED if t not in ("NaN", "inf", "Infinity")]


def test_every_listed_column_must_be_a_number(spark):
    df = spark.createDataFrame([("1", "2"), ("1", "x"), ("x", "2"), (None, "2")], "h string, w string")
    assert [tuple(r) for r in keep_numeric(df, ["h", "w"]).collect()] == [("1", "2")]
    assert keep_numeric(df, []).count() == 4


def test_casts(spark):
    df = spark.createDataFrame([("1.5", 7)], "h string, k int")
    cast = cast_columns(df, {"h": "double", "k": "string"})
    assert cast.dtypes == [("h", "double"), ("k", "string")]
    assert cast.first() == (1.5, "7")


def half_up(values, digits):
    total = sum(Decimal(repr(v)) for v in values)
    return float((total / len(values)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def average(spark, values, digits=2, exact_scale=2, partitions=1):
    df = spark.createDataFrame([(1, v) for v in values], "k int, x double").repartition(partitions)
    return group_averages(df, ["k"], ["x"], digits, exact_scale, stamp=None).first().avg_x


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cents=st.lists(st.integers(-(10**11), 10**11), min_size=1, max_size=20), parts=st.integers(1, 4))
def test_exact_average_equals_decimal_arithmetic(spark, cents, parts):
    values = [c / 100 for c in cents]
    assert average(spark, values, partitions=parts) == half_up(values, 2)


@pytest.mark.parametrize(
    "values, digits, scale, expected",
    [
        ([1.0, 1.01], 2, 2, 1.01),
        ([-1.0, -1.01], 2, 2, -1.01),
        ([0.01, -0.01], 2, 2, 0.0),
        ([-0.01, 0.0, 0.0], 2, 2, 0.0),
        ([1.005], 2, 3, 1.01),
        ([1.0, 2.0, 2.0], 4, 0, 1.6667),
        ([1.25], 1, 2, 1.3),
        ([170.0, None], 2, 2, 170.0),
        ([1e12, 1e12 + 0.5], 2, 2, 1e12 + 0.25),
    ],
)
def test_exact_average_cases(spark, values, digits, scale, expected):
    result = average(spark, values, digits, scale)
    assert result == expected
    assert math.copysign(1, result) == math.copysign(1, expected)


def test_values_that_cannot_be_exact_use_the_double_average(spark):
    assert math.isnan(average(spark, [1.0, float("nan")]))
    assert average(spark, [1.0, float("inf")]) == float("inf")
    assert average(spark, [1e20, 3e20]) == 2e20
    assert average(spark, [None, None]) is None


def test_large_finite_values_are_exact_in_any_order(spark):
    """One value beyond the integer parts does not make its group depend on the order of the rows."""
    values = [3e15, -3e15, 0.01, 0.02, 0.02]
    for shift in range(5):
        assert average(spark, values[shift:] + values[:shift], partitions=shift + 1) == 0.01
    assert average(spark, [2.0**53, 2.0**53 + 4]) == 2.0**53 + 2


def test_default_form_is_the_rounded_double_average(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 2.0)], "k int, x double")
    assert group_averages(df, ["k"], ["x"], stamp=None).first().avg_x == 1.67
    text = spark.createDataFrame([(1, "180"), (1, "181.5")], "k int, x string")
    assert group_averages(text, ["k"], ["x"], stamp=None).first().avg_x == 180.75
