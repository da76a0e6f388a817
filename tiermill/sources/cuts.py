"""Balanced cuts of a table that is read by conditions, from a sample of its keys."""

from __future__ import annotations

import datetime
import decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sampled rows per part; the share of a part then strays by some 7%.
ROWS_PER_PART = 200
_KEYS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _literal(value: object) -> str:
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    return format(value, "f") if isinstance(value, decimal.Decimal) else str(value)


def _ranges(column: str, cuts: list[object]) -> list[str]:
    """Conditions that cover every value of ``column`` once, nulls in the first."""
    if not cuts:
        return [f"({column} IS NOT NULL OR {column} IS NULL)"]
    first, last = f"({column} < {_literal(cuts[0])} OR {column} IS NULL)", f"({column} >= {_literal(cuts[-1])})"
    between = [f"({column} >= {_literal(a)} AND {column} < {_literal(b)})" for a, b in zip(cuts, cuts[1:])]
    return [first, *between, last]


def _even(values: list[object], parts: int) -> list[object]:
    """Values at which the sorted ``values`` are cut into about ``parts`` equal pieces, copies kept together."""
    cuts = dict.fromkeys(values[len(values) * n // parts] for n in range(1, parts)) if values else {}
    return [cut for cut in cuts if cut > values[0]]


def balanced_conditions(
    keys: DataFrame, column: str, parts: int, then: str | None = None, rows_per_part: int = ROWS_PER_PART, seed: int = 0
) -> list[str]:
    """About ``parts`` SQL conditions on ``column`` that cover every row once and hold about equally many.

    ``keys`` holds the table's keys, or a sample of them: some ``rows_per_part`` times ``parts`` rows, drawn at random, are fetched.
    Equal ranges (``KeyRange``) put most rows of a skewed key into few parts; these cuts are quantiles. A value that alone
    fills more than half a part has a part of its own, and is cut further by ``then``, a second column such as the primary key, if
    one is given. Columns are numbers without fractions beyond a decimal's, dates or timestamps, which databases and Spark
    order alike, unlike text. Nulls are in the first part. No rows give one condition that is always true.
    """
    if parts < 1:
        raise ValueError("at least one part")
    names = [column] if then is None else [column, then]
    for name in names:
        if not isinstance(keys.schema[name].dataType, _KEYS):
            raise TypeError(f"{name} is {keys.schema[name].dataType.simpleString()}; cuts need whole numbers, decimals, dates or timestamps")
    wanted, held = rows_per_part * parts, keys.select(*[f"`{n}`" for n in names])
    share = min(1.0, wanted / max(held.count(), 1))
    rows = held.filter(F.col(f"`{column}`").isNotNull()).sample(False, share, seed).collect() if share < 1 else held.dropna(subset=[column]).collect()
    rows = sorted((tuple(r) for r in rows), key=lambda r: r[0])
    if not rows:
        return _ranges(column, [])
    groups: dict[object, list[object]] = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row[-1])
    part = max(len(rows) / parts, 1)

    # Values in order; a part ends where it is full, and before and behind a heavy value.
    cuts: list[object] = []
    heavy: dict[object, list[object]] = {}
    filled, after_heavy = 0, False
    for n, (value, seconds) in enumerate(groups.items()):
        is_heavy = 2 * len(seconds) > part
        if n and (is_heavy or after_heavy or filled + len(seconds) / 2 > part):
            cuts.append(value)
            filled = 0
        filled += len(seconds)
        after_heavy = is_heavy
        if is_heavy and then is not None:
            pieces = round(len(seconds) / part)
            seconds = sorted(s for s in seconds if s is not None)
            heavy[value] = _even(seconds, pieces) if pieces > 1 else []
    conditions = []
    starts = [None, *cuts]
    for start, condition in zip(starts, _ranges(column, cuts)):
        value = next(iter(groups)) if start is None else start
        more = heavy.get(value)
        conditions += [condition] if not more else [f"({condition} AND {piece})" for piece in _ranges(then, more)]
    return conditions
