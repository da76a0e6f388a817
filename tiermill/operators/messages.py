"""Rows as (key, value) messages with a JSON value, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def encode(df: DataFrame, key: str | Column) -> DataFrame:
    """One message per row: ``key`` as text, ``value`` the whole row as JSON without its null fields."""
    key_column = F.col(key) if isinstance(key, str) else key
    return df.select(key_column.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def value_text(messages: DataFrame) -> DataFrame:
    """The message value as text."""
    return messages.selectExpr("CAST(value AS STRING) AS value")


def string_schema(fields: list[str] | tuple[str, ...]) -> T.StructType:
    """Record schema in which every field is a nullable string."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in fields])


def decode(messages: DataFrame, schema: T.StructType, fields: list[str] | None = None) -> DataFrame:
    """The fields of each message's JSON value, one row per message; a bad value gives a row of nulls.

    ``fields`` limits the schema to the fields wanted, so the parser skips the rest. Expanding a one-element
    array (and not ``data.*``) keeps Spark from copying the parse below a later filter on one of the
    fields, such as the null check of a join key: each message is parsed once.
    """
    if fields is not None:
        schema = T.StructType([schema[name] for name in fields])
    return messages.select(F.inline(F.array(F.from_json(F.col("value").cast("string"), schema))))
