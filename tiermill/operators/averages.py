"""Rounded averages per group, over a table, a stream or an enriching join."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.functions.numbers import (
    LIMBS,
    average_parts,
    carried_parts,
    exact_average,
    exact_total,
    merged_parts,
    plain_average,
    scaled,
    value_parts,
)
from tiermill.operators.joins import Columns, enrich, named

RunTime = Column | datetime.datetime | None

# Rows of a dimension up to which Spark may broadcast it, reduced, if it takes it for small enough.
BROADCAST_ROWS = 2_000_000


def _outputs(measures: Columns) -> dict[str, str]:
    """Output name -> column; a plain name ``x`` is reported as ``avg_x``."""
    if isinstance(measures, Mapping):
        return dict(measures)
    return {f"avg_{name}": name for name in measures}


def _quoted(name: str) -> str:
    return f"`{name}`"


def _stamp(name: str | None, run_ts: RunTime) -> list[Column]:
    if name is None:
        return []
    if run_ts is None:
        run_ts = F.current_timestamp()
    elif isinstance(run_ts, datetime.datetime):
        run_ts = F.lit(run_ts)
    return [run_ts.alias(name)]


def _values(sources: Mapping[str, str], exact_scale: int | None, cast: str = "CAST") -> list[str]:
    """Measures as doubles under internal names, and scaled to integers if they are to be summed exactly."""
    values = [f"{cast}({_quoted(source)} AS DOUBLE) AS {x}" for x, source in sources.items()]
    if exact_scale is not None:
        values += [f"{scaled(x, exact_scale)} AS {x}_scaled" for x in sources]
    return values


def _finish(
    parts: DataFrame,
    keys: Sequence[str],
    names: Mapping[str, str],
    digits: int,
    exact_scale: int | None,
    stamp: list[Column],
    limbs: int = len(LIMBS),
) -> DataFrame:
    """Keys, rounded averages and time from the parts of each group; ``names`` maps internal to output names."""
    if exact_scale is None:
        rounded = {x: plain_average(x, digits) for x in names}
    else:
        parts = parts.selectExpr("*", *[exact_total(x, limbs) for x in names])
        rounded = {x: exact_average(x, digits, exact_scale) for x in names}
    averages = [F.expr(rounded[x]).alias(name) for x, name in names.items()]
    return parts.select(*map(_quoted, keys), *averages, *stamp)


def group_averages(
    df: DataFrame,
    keys: Sequence[str],
    measures: Columns,
    digits: int = 2,
    exact_scale: int | None = None,
    stamp: str | None = "timestamp",
    run_ts: RunTime = None,
) -> DataFrame:
    """Average of each measure per group, rounded half up, with the time of the run.

    Measures are cast to double; given as names, ``x`` is reported as ``avg_x``. A null key is a group of its own.
    The default is the rounded double average, whose last digit may depend on the order of the rows when
    the average falls on a tie. ``exact_scale`` states how many decimals the measures hold; the sum is then
    taken over integers and the result is the same in any order. ``stamp`` names the time column (None leaves it out),
    ``run_ts`` replaces the clock. Works on a stream too, then in update or complete mode; a measure that is no number
    counts as null there, so that one bad message does not stop the stream, while in a batch it is an error.
    """
    names = {f"__m{i}": name for i, name in enumerate(_outputs(measures))}
    sources = dict(zip(names, _outputs(measures).values()))
    rows = df.selectExpr(*map(_quoted, keys), *_values(sources, exact_scale, "TRY_CAST" if df.isStreaming else "CAST"))
    parts = [F.expr(part) for x in names for part in average_parts(x, exact_scale)]
    grouped = rows.groupBy(*map(_quoted, keys)).agg(*parts)
    return _finish(grouped, keys, names, digits, exact_scale, _stamp(stamp, run_ts), limbs=3)


@dataclass(frozen=True)
class _Side:
    """One side of the join: its rows under internal names."""

    rows: DataFrame
    name: str
    keys: list[str]
    values: list[str]
    exact_scale: int | None

    @classmethod
    def of(
        cls, df: DataFrame, name: str, on: str, key_type: str | None, keys: Columns, sources: Mapping[str, str],
        exact_scale: int | None,
    ) -> _Side:
        key = f"CAST({_quoted(on)} AS {key_type})" if key_type else _quoted(on)
        kept = [f"{_quoted(source)} AS {_quoted(output)}" for output, source in named(keys).items()]
        rows = df.selectExpr(f"{key} AS __{name}_on", *kept, *_values(sources, exact_scale))
        return cls(rows, name, list(named(keys)), list(sources), exact_scale)

    def single(self) -> DataFrame:
        """A row each, with what it adds to the averages."""
        parts = [
            f"{part} AS {x}_{name}" for x in self.values for name, part in value_parts(x, self.exact_scale).items()
        ]
        return self.rows.selectExpr(*self._by(), f"1L AS __{self.name}_rows", *parts)

    def reduced(self) -> DataFrame:
        """One row per (join key, group keys), with how many rows it stands for and what they add."""
        parts = [part for x in self.values for part in average_parts(x, self.exact_scale)]
        sums = self.rows.groupBy(*self._by()).agg(*map(F.expr, [f"count(1) AS __{self.name}_rows", *parts]))
        carried = [part for x in self.values for part in carried_parts(x, self.exact_scale)]
        return sums.selectExpr(*self._by(), f"__{self.name}_rows", *carried)

    def _by(self) -> list[str]:
        return [f"__{self.name}_on", *map(_quoted, self.keys)]


def enriched_averages(
    facts: DataFrame,
    dimension: DataFrame,
    on: tuple[str, str],
    fact_keys: Columns,
    dimension_keys: Columns,
    fact_measures: Columns = (),
    dimension_measures: Columns = (),
    key_type: str | None = None,
    digits: int = 2,
    exact_scale: int | None = None,
    stamp: str | None = "timestamp",
    run_ts: RunTime = None,
    reduce_first: bool | None = None,
) -> DataFrame:
    """``group_averages`` of ``enrich``: each joined row counts once, however often a key repeats.

    The dimension is reduced to one row per (join key, group keys), holding a row count and partial sums; after the join
    the sums of each side are weighted by the row count of the other. So keys repeated on both sides never multiply
    out. A dimension of up to BROADCAST_ROWS rows is left to Spark, which broadcasts it if it estimates it to be small; the
    facts then stay in place. Spark's estimate does not see rows that a generator or a join multiplies and is not
    taken back, so the rows are counted first (for plain files a look at their footers), and a larger dimension is sorted
    and merged: the facts are shuffled as they are and adaptive execution splits a hot key. The count reads the dimension once
    more where it is no plain file; ``reduce_first=False`` leaves it out and the choice to Spark. The limit changes the way
    alone: exact results stay the same, of the double form the last digit may move.

    ``reduce_first=True`` is for two large sides: the facts are reduced too, before they are shuffled, and both are sorted
    and merged. A key that holds a third of all facts is then as small as any other. The result is the same.

    Facts may be a stream, whose rows are joined as they are. The output names of all keys and measures must differ.
    """
    fact_measures, dimension_measures = _outputs(fact_measures), _outputs(dimension_measures)
    keys = [*named(fact_keys), *named(dimension_keys)]
    fact_sources = {f"__f{i}": source for i, source in enumerate(fact_measures.values())}
    dimension_sources = {f"__d{i}": source for i, source in enumerate(dimension_measures.values())}
    names = dict(zip([*fact_sources, *dimension_sources], [*fact_measures, *dimension_measures]))
    if facts.isStreaming:
        fact_columns = {**named(fact_keys), **fact_sources}
        dimension_columns = {**named(dimension_keys), **dimension_sources}
        joined = enrich(facts, dimension, on, fact_columns, dimension_columns, key_type)
        measures = {name: x for x, name in names.items()}
        return group_averages(joined, keys, measures, digits, exact_scale, stamp, run_ts)

    fact = _Side.of(facts, "fact", on[0], key_type, fact_keys, fact_sources, exact_scale)
    dim = _Side.of(dimension, "dim", on[1], key_type, dimension_keys, dimension_sources, exact_scale)
    left, right = fact.reduced() if reduce_first else fact.single(), dim.reduced()
    if reduce_first or (reduce_first is None and dimension.count() > BROADCAST_ROWS):
        right = right.hint("merge")
    joined = left.join(right, F.col("__fact_on") == F.col("__dim_on"), "inner")
    merged = [part for x in fact_sources for part in merged_parts(x, "__dim_rows", exact_scale, bool(reduce_first))]
    dim_weight = "__fact_rows" if reduce_first else None  # otherwise each fact is a row of its own
    merged += [part for x in dimension_sources for part in merged_parts(x, dim_weight, exact_scale, True)]
    grouped = joined.groupBy(*map(_quoted, keys)).agg(*map(F.expr, merged))
    return _finish(grouped, keys, names, digits, exact_scale, _stamp(stamp, run_ts))


def latest_per_key(history: DataFrame, keys: Sequence[str], order: str = "batch_id") -> DataFrame:
    """The newest row per key of an append-only history, e.g. of what an update-mode stream wrote.

    A plain aggregate, so each input partition first reduces its own rows to one per key.
    """
    values = [c for c in history.columns if c not in {*keys, order}]
    newest = [F.max_by(c, order).alias(c) for c in values]
    return history.groupBy(*keys).agg(*newest, F.max(order).alias(order))
