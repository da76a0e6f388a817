from decimal import Decimal
import datetime
import decimal
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiermill.functions.text import clean_text, value_cleaner
from tiermill.operators.columns import clean_columns, map_columns

# Fixed value: what cleaning deletes.
UNWANTED = re.compile(r"""[^a-zA-Z0-9,.\\"']""")

TEXTS = [
    "Jean-Luc Picard",
    'O\'Neil "the Great", Jr.',
    "back\\slash",
    "Zoë Müller",
    "=3",
    "line\nbreak\ttab",
    "smile 😀 end",
    "",
    "^]-[a&&b]",
    "日本",
    None,
]


def python_clean(value):
    return UNWANTED.sub("", str(value))


def test_native_cleaner_equals_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    rows = df.select("t", clean_text(F.col("t")).alias("c")).collect()
    assert [r.c for r in rows] == [python_clean(r.t) for r in rows]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), min_size=1, max_size=30))
def test_native_cleaner_equals_python_on_any_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.t for r in clean_columns(df, ["t"]).collect()] == [python_clean(t) for t in texts]


def test_null_becomes_token_or_stays(spark):
    df = spark.createDataFrame([(None,), ("a b",)], "t string")
    assert [r[0] for r in df.select(clean_text(F.col("t"))).collect()] == ["None", "ab"]
    assert [r[0] for r in df.select(clean_text(F.col("t"), null_token=None)).collect()] == [None, "ab"]
    assert value_cleaner(null_token=None)(None) is None


def test_cleaning_twice_changes_nothing(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    once = clean_columns(df, ["t"])
    assert clean_columns(once, ["t"]).collect() == once.collect()


def test_other_allow_list(spark):
    df = spark.createDataFrame([("a-b]c^d\\e f",)], "t string")
    assert df.select(clean_text(F.col("t"), keep="abc-]^\\ ")).first()[0] == "a-b]c^\\ "


@pytest.mark.parametrize(
    "type_name, values",
    [
        ("int", [180, -5, None]),
        ("bigint", [2**40]),
        ("boolean", [True, False, None]),
        ("double", [180.5, 1e16, 1e7, 1e-4, float("nan"), float("inf"), None]),
        ("date", [datetime.date(1990, 1, 2)]),
        ("timestamp", [datetime.datetime(1990, 1, 2, 3, 4, 5, 500000), datetime.datetime(1990, 1, 2)]),
        ("decimal(10,2)", [decimal.Decimal("1.50"), decimal.Decimal("0.00")]),
    ],
)
def test_typed_columns_are_cleaned_as_python_text(spark, type_name, values):
    df = spark.createDataFrame([(v,) for v in values], f"v {type_name}")
    assert [r.v for r in clean_columns(df, ["v"]).collect()] == [python_clean(v) for v in values]


def test_string_columns_stay_in_the_jvm(spark, plan_of):
    df = spark.createDataFrame([("a", 1, 1.5)], "t string, i int, d double")
    assert "Python" not in plan_of(clean_columns(df.repartition(2), ["t", "i"]))
    with pytest.warns(UserWarning, match="d$"):
        assert "ArrowEvalPython" in plan_of(clean_columns(df.repartition(2), ["t", "d"]))


def test_booleans_and_short_decimals_stay_in_the_jvm(spark, plan_of):
    values = [(True, Decimal("1.50"), Decimal("0.000000")), (False, Decimal("-0.05"), Decimal("0.000001")), (None, None, None)]
    df = spark.createDataFrame(values, "b boolean, d decimal(10,2), e decimal(20,6)").repartition(1)
    cleaned = clean_columns(df, ["b", "d", "e"])
    assert "Python" not in plan_of(cleaned)
    clean = value_cleaner()
    assert sorted(map(tuple, cleaned.collect())) == sorted(tuple(clean(v) for v in row) for row in values)


def test_map_columns_applies_any_function(spark):
    df = spark.createDataFrame([("a", "b"), (None, "c")], "x string, y string")
    mapped = map_columns(df, ["x", "y"], lambda v: "-" if v is None else v.upper())
    assert [tuple(r) for r in mapped.collect()] == [("A", "B"), ("-", "C")]
