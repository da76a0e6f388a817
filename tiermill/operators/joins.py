"""The enriching join: facts take columns from a dimension table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A selection: column names, or output name -> column name.
Columns = Sequence[str] | Mapping[str, str]

# Second join key of facts that are spread over several copies of the dimension.
SALT = "__salt"


def named(columns: Columns) -> dict[str, str]:
    """A selection as output name -> column name."""
    return dict(columns) if isinstance(columns, Mapping) else {name: name for name in columns}


def pick(side: str, columns: Columns) -> list[Column]:
    """Columns of one aliased join side under their output names."""
    return [F.col(f"{side}.`{source}`").alias(name) for name, source in named(columns).items()]


def key_of(side: str, name: str, key_type: str | None) -> Column:
    """Join key of one side, cast if a type is given."""
    key = F.col(f"{side}.`{name}`")
    return key.cast(key_type) if key_type else key


def _is_hot(key: Column, hot: Sequence[str]) -> Column:
    return F.coalesce(key.cast("string").isin(*hot), F.lit(False)) if hot else F.lit(False)


def spread(dimension: DataFrame, key: str, hot: Sequence[str], copies: int) -> DataFrame:
    """The rows of hot keys ``copies`` times, numbered from 0, for facts numbered by ``salted``; all others once, as 0."""
    last = F.when(_is_hot(F.col(f"`{key}`"), hot), F.lit(copies - 1)).otherwise(F.lit(0))
    return dimension.withColumn(SALT, F.explode(F.sequence(F.lit(0), last)))


def salted(key: Column, hot: Sequence[str], copies: int) -> Column:
    """Which copy of a hot key's rows a fact meets: any, for equal facts too. A task that is run again draws the same."""
    turn = (F.rand(copies) * copies).cast("int")
    return F.when(_is_hot(key, hot), turn).otherwise(F.lit(0)).alias(SALT)


def hot_keys(facts: DataFrame, key: str, share: float = 0.02) -> list[str]:
    """The keys, as text, that hold more than ``share`` of the rows of a batch table: fewer than 1 / share of them.

    The table that feeds a stream tells which keys its messages will crowd.
    """
    counts = facts.groupBy(F.col(f"`{key}`").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    total = facts.count()
    found = counts.filter(F.col("key").isNotNull() & (F.col("rows") > share * total)).select("key").collect()
    return sorted(row["key"] for row in found)


def enrich(
    facts: DataFrame,
    dimension: DataFrame,
    on: tuple[str, str],
    fact_columns: Columns,
    dimension_columns: Columns,
    key_type: str | None = None,
) -> DataFrame:
    """Inner join on ``on`` = (fact key, dimension key), keeping only the columns named.

    Facts may be a stream. Null keys match nothing. ``key_type="string"`` compares the keys as text, as
    JSON messages need. Spark broadcasts a side that is under its size limit and sorts and merges
    otherwise; adaptive execution splits a key that is too large for one task. Streams have no adaptive
    execution: there, facts with a ``salted`` number and a ``spread`` dimension divide every key evenly.
    """
    condition = key_of("fact", on[0], key_type) == key_of("dim", on[1], key_type)
    if SALT in dimension.columns:
        condition = condition & (F.col(f"fact.{SALT}") == F.col(f"dim.{SALT}"))
    joined = facts.alias("fact").join(dimension.alias("dim"), condition, "inner")
    return joined.select(*pick("fact", fact_columns), *pick("dim", dimension_columns))
