"""How filters that are applied one after another interact, over all their orders.

A state of the subset lattice is the set of filters applied so far, an edge applies one more. What survives a state does not
depend on the order in which it was reached, so every step of every order is read from the edges: n * 2^(n-1) of them in
place of n * n! steps. Counting the paths forward from the empty set and backward from the full one tells how many orders
pass through an edge, which weights what it removes.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.common import extended
from tiermill.llm.words import words_in_pieces

# Orders of so many filters can still be listed: 40,320.
MOST_FILTERS = 8
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_STEPS = "array<struct<filter_order: string, step: int>>"
_EDGES = f"array<struct<before: int, after: int, filter: int, alone: int, orders: bigint, steps: {_STEPS}>>"


def paths(filters: int) -> tuple[list[int], list[int]]:
    """Per state, as a bit set: in how many orders it is reached from the empty set, and the full set from it."""
    states, full = range(1 << filters), (1 << filters) - 1
    reaching, leaving = [0] * len(states), [0] * len(states)
    reaching[0] = leaving[full] = 1
    for state in states[1:]:
        reaching[state] = sum(reaching[state & ~(1 << f)] for f in range(filters) if state >> f & 1)
    for state in reversed(states[:-1]):
        leaving[state] = sum(leaving[state | 1 << f] for f in range(filters) if not state >> f & 1)
    return reaching, leaving


def edges(names: Sequence[str]) -> list[dict[str, object]]:
    """The edges of the lattice, each with the number of orders through it and the steps of these orders."""
    reaching, leaving = paths(len(names))
    steps: dict[tuple[int, int], list[dict[str, object]]] = {}
    for order in itertools.permutations(range(len(names))):
        before = 0
        for step, f in enumerate(order, 1):
            steps.setdefault((before, f), []).append({"filter_order": "".join(names[i] for i in order), "step": step})
            before |= 1 << f
    full = (1 << len(names)) - 1
    return [
        {"before": before, "after": before | 1 << f, "filter": f, "alone": full & ~(1 << f),
         "orders": reaching[before] * leaving[before | 1 << f], "steps": through}
        for (before, f), through in steps.items()
    ]


def filter_audit(
    rows: DataFrame, filters: Sequence[str], part: str, marks: Sequence[str] = (), count: str | None = None
) -> DataFrame:
    """What each filter removes at each step of each order of ``filters``, for every value of ``part``.

    ``filters`` are boolean columns, true where a row fails (null: it passes); at most 8, as all orders are listed.
    ``marks`` are boolean columns whose removed rows are counted too. A row counts ``count`` times, or once. Columns:
    ``part``, filter_order (the names put together), step (from 1), kept, removed, redundant (fails this filter, removed
    earlier), unique_fails (fails this one alone), ``<mark>_lost``, shapley (removed by this filter, summed over all
    orders). Parts whose rows all pass have zeros; a null part is one of its own; an empty table gives no rows.

    Rows are added up where they lie to 2^n counts a part, so no part or pattern is a hot key.
    """
    if not 0 < len(filters) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters can be audited, not {len(filters)}")
    weight = F.lit(1).cast("bigint") if count is None else F.col(f"`{count}`")
    fails = sum((F.when(F.col(f"`{f}`"), 1 << i).otherwise(0) for i, f in enumerate(filters)), F.lit(0))
    named = [F.col(f"`{m}`").alias(f"mark{i}") for i, m in enumerate(marks)]
    patterns = rows.select(F.col(f"`{part}`").alias("part"), fails.alias("fails"), weight.alias("n"), *named)
    measures = ["n", *[f"if(mark{i}, n, 0L)" for i in range(len(marks))]]
    patterns = patterns.groupBy("part", "fails").agg(*[F.expr(f"sum({m}) AS m{i}") for i, m in enumerate(measures)])

    # Who survives each state: an array per measure, at the state's number.
    states = range(1 << len(filters))
    left = [f"array({', '.join(f'sum(if((fails & {s}) = 0, m{i}, 0L))' for s in states)}) AS left{i}" for i in range(len(measures))]
    survivors = patterns.groupBy("part").agg(*map(F.expr, left))

    lattice = F.from_json(F.lit(json.dumps(edges(filters))), _EDGES)
    lost = [f"left{i}[before] - left{i}[after] AS lost{i}" for i in range(len(measures))]
    along = survivors.select("*", F.inline(lattice)).selectExpr(
        "part", "filter", "orders", "steps", "left0[after] AS kept", *lost,
        "(left0[0] - left0[shiftleft(1, filter)]) - (left0[before] - left0[after]) AS redundant",
        f"left0[alone] - left0[{len(states) - 1}] AS unique_fails",
    )
    weighted = F.sum(F.col("lost0") * F.col("orders")).over(Window.partitionBy("part", "filter"))
    along = along.withColumn("shapley", weighted).select("*", F.inline("steps"))
    marked = [F.col(f"lost{i}").alias(f"{m}_lost") for i, m in enumerate(marks, 1)]
    counts = ["kept", F.col("lost0").alias("removed"), "redundant", "unique_fails", *marked, "shapley"]
    return along.select(F.col("part").alias(part), "filter_order", "step", *counts)


@dataclass(frozen=True)
class TextRules:
    """Limits of the filters on one text: it fails A with fewer words, B with a smaller percentage of distinct words,
    C with a larger percentage of the letters A-Z among its characters, D if it holds one of the marks."""

    least_words: int = 200
    least_distinct: int = 50
    most_capitals: int = 2
    marks: bytes = b"#$%&*|"

    def failures(self, data: bytes, characters: int) -> tuple[bool, bool, bool, bool]:
        words, distinct = 0, set()
        for piece in words_in_pieces(data):
            words += len(piece)
            distinct.update(piece)
        capitals = len(data) - len(data.translate(None, CAPITALS))
        return (
            words < self.least_words,
            100 * len(distinct) < self.least_distinct * words,
            100 * capitals > self.most_capitals * characters,
            len(data.translate(None, self.marks)) < len(data),
        )


def text_failures(docs: DataFrame, labels: DataFrame, part: str = "source", rules: TextRules = TextRules()) -> DataFrame:
    """Which filters the documents fail, counted: rows of (``part``, A, B, C, D, E, good, toxic, rows).

    A to D are ``rules``; E is a text that a document of a smaller doc_id has too, in the whole table. A null text is
    empty and a null ``part`` the empty string. Rows without a doc_id pass E and make no other row fail; rows that
    share doc_id and text are no copies of each other. ``good`` and ``toxic`` are the documents that any row of ``labels`` (doc_id,
    quality, toxic) calls so.

    Texts stay where they are read: digests travel (SHA-256), counted before each shuffle, so a text or a row repeated any
    number of times is no hot key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts, texts = batch.columns
            digests, found = [], []
            for text, characters in zip(texts.cast(pa.binary()), pc.utf8_length(texts).to_pylist()):
                data = text.as_py() or b""
                digests.append(hashlib.sha256(data).digest())
                found.append(rules.failures(data, characters or 0))
            fails = [pa.array([f[i] for f in found], pa.bool_()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([ids, parts, pa.array(digests, pa.binary()), *fails], names=names)

    narrow = docs.select("doc_id", F.coalesce(F.col(f"`{part}`"), F.lit("")).alias("__part"), "text")
    schema = extended(narrow.drop("text").schema, "text binary, A boolean, B boolean, C boolean, D boolean")
    names = schema.names
    rows = narrow.mapInArrow(run, schema).groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    called = [F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(a) for c, a in (("quality", "good"), ("toxic", "toxic"))]
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*called)
    rows = rows.join(known, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    same = rows.groupBy("text", "__part", "good", "toxic", "A", "B", "C", "D").agg(
        F.sum("copies").alias("rows"),
        F.sum(F.when(F.col("doc_id").isNotNull(), F.col("copies")).otherwise(0)).alias("with_id"),
        F.min("doc_id").alias("lowest"),
        F.min_by("copies", "doc_id").alias("at_lowest"),
    )
    first = F.min("lowest").over(Window.partitionBy("text"))  # a row per part and marks
    same = same.withColumn("at_first", F.when(F.col("lowest") == first, F.col("at_lowest")).otherwise(0))
    repeats = F.col("with_id") - F.col("at_first")
    split = F.inline(F.array(*[F.struct(F.lit(e).alias("E"), n.alias("rows")) for e, n in ((False, F.col("rows") - repeats), (True, repeats))]))
    counted = same.select(F.col("__part").alias(part), "A", "B", "C", "D", "good", "toxic", split)
    return counted.filter("rows > 0")
