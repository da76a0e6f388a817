"""Row and column clean-up: text, casts, number filter, duplicates."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.functions.numbers import is_number
from tiermill.functions.text import KEPT_CHARACTERS, NULL_TOKEN, clean_text, value_cleaner

# Up to this scale Python writes a decimal without an exponent, as Spark does.
PLAIN_SCALE = 6


def _same_text(data_type: T.DataType) -> bool:
    """Whether ``CAST(x AS STRING)`` and Python's ``str(x)`` agree for every value of the type."""
    if isinstance(data_type, T.DecimalType):
        return data_type.scale <= PLAIN_SCALE
    return isinstance(
        data_type,
        (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.NullType),
    )


def clean_columns(
    df: DataFrame,
    columns: Sequence[str],
    keep: str = KEPT_CHARACTERS,
    null_token: str | None = NULL_TOKEN,
) -> DataFrame:
    """Clean the listed columns; each becomes a string.

    Strings, integers, decimals, booleans and dates are cleaned inside the JVM. Types that Spark and Python write
    differently (doubles, timestamps, decimals of many places) go through the Python cleaner, so the text is Python's. That
    is slower: a warning names the columns, and a declared text schema avoids it.
    """
    flags = [c for c in columns if isinstance(df.schema[c].dataType, T.BooleanType)]
    df = df.withColumns({c: F.initcap(df[c].cast("string")) for c in flags})  # True and False, as Python writes them
    native = [c for c in columns if _same_text(df.schema[c].dataType)]
    df = df.withColumns({c: clean_text(df[c], keep, null_token) for c in native})
    foreign = [c for c in columns if c not in native]
    if not foreign:
        return df
    warnings.warn(f"cleaned in Python, because of their types: {', '.join(foreign)}", stacklevel=2)
    return map_columns(df, foreign, value_cleaner(keep, null_token))


def map_columns(df: DataFrame, columns: Sequence[str], fn: Callable[[object], str | None]) -> DataFrame:
    """Replace each listed column by ``fn`` of its value, as a string. The slow path, for custom cleaners.

    Values travel in Arrow batches.
    """
    mapped = F.udf(fn, T.StringType(), useArrow=True)
    return df.withColumns({c: mapped(df[c]) for c in columns})


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns, e.g. ``{"height": "double", "athlete_id": "string"}``."""
    return df.withColumns({name: F.col(name).cast(to) for name, to in types.items()})


def keep_numeric(df: DataFrame, columns: Sequence[str], finite_only: bool = False) -> DataFrame:
    """Keep the rows in which every listed column parses as a double."""
    valid: Column = F.lit(True)
    for name in columns:
        valid = valid & is_number(F.col(name), finite_only)
    return df.filter(valid)


def dedupe(df: DataFrame) -> DataFrame:
    """Drop rows that equal another row in every column.

    Copies are merged before the shuffle, within each input partition, so a row that makes up a third
    of the table reaches the shuffle at most once per task.
    """
    return df.dropDuplicates()
