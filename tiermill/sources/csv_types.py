"""Types of CSV columns found in the pass that lands the file.

Every value is the narrowest of a few kinds; a column is their union, a set of bits that merges over rows, tasks and files. It is
collected as a metric of the job that writes the text to columns, and the types are applied when that is read, so the
CSV itself is read once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tiermill.sinks.files import write_parquet
from tiermill.sources.files import read_csv, working_folder

INTEGER, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << n for n in range(8))
_NUMBERS = INTEGER | LONG | DECIMAL | DOUBLE
# How numbers that are not finite are written, and digits of the whole types in decimals.
_SPECIAL = ("NaN", "Inf", "-Inf", "Infinity", "-Infinity", "+Infinity")
_DIGITS = {INTEGER: 10, LONG: 20}
_MOST_DIGITS = 38


def kind_of(text: str) -> str:
    """SQL for the kind of the text ``text``: the narrowest type that Spark's own inference would give it alone; 0 if empty."""
    whole, special = f"{text} RLIKE '^[-+]?[0-9]+$'", ", ".join(f"'{s}'" for s in _SPECIAL)
    return f"""CASE
        WHEN {text} IS NULL OR {text} = '' THEN 0
        WHEN NOT {text} RLIKE '^\\\\s*[-+0-9.TtFfNI]' THEN {TEXT}
        WHEN {whole} AND TRY_CAST({text} AS INT) IS NOT NULL THEN {INTEGER}
        WHEN {whole} AND TRY_CAST({text} AS BIGINT) IS NOT NULL THEN {LONG}
        WHEN {text} RLIKE '^[-+]?[0-9]+[.]?$' AND {digits_of(text)} <= {_MOST_DIGITS} THEN {DECIMAL}
        WHEN {text} RLIKE '^[-+]?[A-Z]' THEN CASE WHEN {text} IN ({special}) THEN {DOUBLE} {_other_kind(text)}
        WHEN {text} RLIKE '^\\\\s*[-+]?[0-9.]' AND TRY_CAST({text} AS DOUBLE) IS NOT NULL THEN {DOUBLE}
        ELSE CASE {_other_kind(text)} END"""


def _other_kind(text: str) -> str:
    return f"""WHEN {text} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' AND TRY_CAST({text} AS DATE) IS NOT NULL THEN {DATE}
        WHEN {text} RLIKE '[-:]' AND NOT {text} RLIKE 'T$' AND TRY_CAST({text} AS TIMESTAMP) IS NOT NULL THEN {TIMESTAMP}
        WHEN lower({text}) IN ('true', 'false') THEN {BOOLEAN} ELSE {TEXT} END"""


def digits_of(text: str) -> str:
    """SQL for the number of digits of a whole number, without zeros in front."""
    return f"greatest(length(regexp_replace({text}, '^[-+]?0*|[.]$', '')), 1)"


def type_of(kinds: int, digits: int) -> str:
    """The type of a column of these kinds, whose decimals have up to ``digits`` digits."""
    if kinds and not kinds & ~_NUMBERS:
        if kinds & DOUBLE:
            return "double"
        if kinds & DECIMAL:
            return f"decimal({max(digits, *(n for kind, n in _DIGITS.items() if kinds & kind), 0)},0)"
        return "bigint" if kinds & LONG else "int"
    if kinds and not kinds & ~(DATE | TIMESTAMP):
        return "timestamp" if kinds & TIMESTAMP else "date"
    return "boolean" if kinds == BOOLEAN else "string"


def observed_kinds(text: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, str]]]:
    """``text``, all columns text, and a function that gives their types once a job has read all of it."""
    seen, metrics = Observation(), []
    for n, column in enumerate(text.columns):
        name = "`" + column.replace("`", "``") + "`"
        kind = kind_of(name)
        metrics.append(F.expr(f"bit_or({kind})").alias(f"k{n}"))
        # only texts beyond a bigint or with a point at the end are decimals; others are not looked at once more
        may_be = f"length({name}) > 18 OR {name} LIKE '%.'"
        metrics.append(F.expr(f"max(CASE WHEN ({may_be}) AND ({kind}) = {DECIMAL} THEN {digits_of(name)} END)").alias(f"d{n}"))

    def types() -> dict[str, str]:
        found = seen.get
        return {c: type_of(found.get(f"k{n}") or 0, found.get(f"d{n}") or 0) for n, c in enumerate(text.columns)}

    return text.observe(seen, *metrics), types


def land_csv(
    spark: SparkSession, path: str, out: str, write: Callable[[DataFrame, str], object] = write_parquet
) -> dict[str, str]:
    """Write a CSV file with a header line as typed parquet, reading it once; returns the types.

    They are those of Spark's inference, but do not depend on the order of the rows: a column of years and dates is
    text, whichever comes first. The rows are written as text to the working folder, read from there and cast.
    """
    text = read_csv(spark, path, infer=False)
    watched, types = observed_kinds(text)
    folder = working_folder(spark, "landing")
    watched.write.parquet(folder)
    found = types()
    landed = spark.read.schema(text.schema).parquet(folder)
    write(landed.select(*[F.col("`" + c.replace("`", "``") + "`").try_cast(t).alias(c) for c, t in found.items()]), out)
    return found
