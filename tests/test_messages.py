import json

import pytest
from pyspark.sql import functions as F

from tiermill.operators.messages import decode, encode, string_schema, value_text
from tiermill.plans.athletes import RESULT_FIELDS, RESULT_SCHEMA
from tiermill.plans.tables import valid_dimension


def test_encode_leaves_out_null_fields_and_takes_any_key(spark):
    df = spark.createDataFrame([(1, "a", None), (None, None, 2.5)], "k int, s string, x double")
    rows = encode(df, "k").collect()
    assert [r.key for r in rows] == ["1", None]
    assert [json.loads(r.value) for r in rows] == [{"k": 1, "s": "a"}, {"x": 2.5}]
    assert encode(df, F.upper("s")).first().key == "A"


def test_decode_is_permissive(spark):
    schema = string_schema(["a", "b"])
    values = [
        ('{"a":"1","b":"x"}', ("1", "x")),
        ('{"a":1.0,"b":true}', ("1.0", "true")),
        ('{"b":{"c":[1]}}', (None, '{"c":[1]}')),
        ('{"A":"1"}', (None, None)),
        ("not json", (None, None)),
        ('{"a":', (None, None)),
        ('["a"]', (None, None)),
        (None, (None, None)),
    ]
    df = spark.createDataFrame([(v,) for v, _ in values], "value string")
    assert [tuple(r) for r in decode(df, schema).collect()] == [e for _, e in values]
    binary = df.select(F.col("value").cast("binary").alias("value"))
    assert decode(binary, schema).collect() == decode(df, schema).collect()
    assert value_text(binary).collect() == df.collect()


def test_decode_of_encode_gives_the_rows_back(spark):
    rows = [tuple(f"{f}é\"\\\n{i}" if (i + n) % 3 else None for n, f in enumerate(RESULT_FIELDS)) for i in range(5)]
    df = spark.createDataFrame(rows, RESULT_SCHEMA)
    assert decode(encode(df, "athlete_id"), RESULT_SCHEMA).collect() == df.collect()


def test_each_message_is_parsed_once(spark, plan_of):
    messages = spark.createDataFrame([("k", '{"a":"1","b":"2"}')], "key string, value string").repartition(2)
    names = spark.createDataFrame([("1", "one")], "id string, s string")
    facts = decode(messages, string_schema(["a", "b", "c"]), ["a"])
    assert facts.columns == ["a"]
    plan = plan_of(facts.join(names, facts.a == names.id))
    assert plan.count("from_json") == 1
    assert "StructField(c" not in plan


def test_valid_dimension(spark):
    df = spark.createDataFrame([(1, "180", "na"), (2, "180.5", "70"), (3, None, "70")], "id int, h string, w string")
    valid = valid_dimension(df, "id", ["h", "w"])
    assert valid.dtypes == [("id", "string"), ("h", "double"), ("w", "double")]
    assert [tuple(r) for r in valid.collect()] == [("2", 180.5, 70.0)]
    with pytest.raises(Exception):
        valid_dimension(df, "missing", ["h"])
