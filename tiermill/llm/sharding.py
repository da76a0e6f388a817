"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

The permutation acts on pairs (left, right) of a left side of ``ceil(sqrt(n))`` and a right side just large enough, so its
domain exceeds the ``n`` row numbers by less than the square root of ``n``. Row numbers that it sends beyond ``n`` are
walked on along their cycle until they come back below ``n``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.common import buckets_before, giving_way, staged

ROUNDS = 4
# Copies of one row that one task writes out.
COPIES_AT_ONCE = 100_000


def _sides(total: Column) -> tuple[Column, Column]:
    left = F.greatest(F.ceil(F.sqrt(total.cast("double"))).cast("bigint"), F.lit(1).cast("bigint"))
    return left, F.call_function("div", total + left - 1, left)


def _feistel(x: Column, left_size: Column, right_size: Column, seed: int, rounds: int) -> Column:
    left, right = F.call_function("div", x, right_size), x % right_size
    for turn in range(rounds):
        if turn % 2 == 0:
            left = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(seed), F.lit(turn)), left_size), left_size)
        else:
            right = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(seed), F.lit(turn)), right_size), right_size)
    return left * right_size + right


def permuted(number: Column, total: Column, seed: int = 0, rounds: int = ROUNDS) -> Column:
    """Where the permutation of 0 .. total - 1 sends ``number``.

    A cycle passes through at most ``domain - total`` numbers beyond ``total`` in a row, which bounds the walk exactly; only
    the few rows that leave the range walk at all.
    """
    left_size, right_size = _sides(total)
    first = _feistel(number, left_size, right_size, seed, rounds)
    spare = F.greatest(left_size * right_size - total, F.lit(1).cast("bigint"))
    walked = F.aggregate(
        F.sequence(F.lit(1).cast("bigint"), spare),
        first,
        lambda at, _: F.when(at < total, at).otherwise(_feistel(at, left_size, right_size, seed, rounds)),
    )
    return F.when(first < total, first).otherwise(walked)


def row_numbers(rows: DataFrame, keys: Sequence[str] | None = None, buckets: int = 4096) -> DataFrame:
    """``rows`` with global numbers (``number``, 0 to n - 1, none left out) and the number of rows (``total``).

    The numbers depend on the rows alone, not on files, partitions or their order: rows are dealt to hashed
    buckets, sorted there by ``keys`` (default: all columns) and then by the rest. Equal rows are counted before they
    are shuffled, so a row repeated any number of times is no hot key; they get numbers in a row. Nulls sort first. The
    columns must be sortable; pass narrow rows (ids and digests) and join long texts back. Columns of ``rows`` called
    ``number`` or ``total`` are renamed ``number_in`` and ``total_in``.
    """
    names, places = giving_way(rows, ["number", "total"]).columns, range(len(rows.columns))
    order = [rows.columns.index(k) for k in keys or []]
    order += [i for i in places if i not in order]
    rows = rows.toDF(*[f"c{i}" for i in places])
    columns = [f"c{i}" for i in order]
    bucket = F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")
    counted = rows.groupBy(bucket.alias("bucket"), *columns).agg(F.count(F.lit(1)).alias("copies"))
    counted = staged(counted, "row-numbers")
    within = Window.partitionBy("bucket").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    first = counted.withColumn("first", F.coalesce(F.sum("copies").over(within), F.lit(0)))
    before = F.broadcast(buckets_before(counted, "bucket", F.col("copies")))  # one row per bucket
    first = first.join(before, "bucket").withColumn("first", F.col("before") + F.col("first"))

    few = first.filter(F.col("copies") <= COPIES_AT_ONCE).withColumn("part", F.lit(0).cast("bigint"))
    last_part = F.call_function("div", F.col("copies") - 1, F.lit(COPIES_AT_ONCE))
    many = first.filter(F.col("copies") > COPIES_AT_ONCE)
    many = many.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last_part))).repartition("part")
    start = F.col("part") * COPIES_AT_ONCE
    copy = F.sequence(start, F.least(F.col("copies"), start + COPIES_AT_ONCE) - 1)
    each = few.unionByName(many).withColumn("copy", F.explode(copy))
    number = (F.col("first") + F.col("copy")).cast("bigint")
    return each.select(*[F.col(f"c{i}").alias(names[i]) for i in places], number.alias("number"), "total")


def shard_rows(
    rows: DataFrame, shards: int, seed: int = 0, keys: Sequence[str] | None = None, buckets: int = 4096
) -> DataFrame:
    """``rows`` with their ``shard`` and gapless ``slot`` in it, in a shuffled order that ``seed`` settles.

    Shard counts differ by one at most. ``number`` and ``total`` stay in the result, so that any row's place can be
    computed again with ``permuted``. An empty table gives no rows; equal rows get different slots. Columns of ``rows``
    called ``number``, ``total``, ``shard`` or ``slot`` are renamed with ``_in`` behind.
    """
    renamed = giving_way(rows, ["number", "total", "shard", "slot"])
    keys = [renamed.columns[rows.columns.index(k)] for k in keys or []]
    spread = row_numbers(renamed, keys, buckets)
    at = permuted(F.col("number"), F.col("total"), seed)
    spread = spread.select("*", at.alias("__at"))
    shard, slot = (F.col("__at") % shards).cast("int"), F.call_function("div", F.col("__at"), F.lit(shards))
    return spread.withColumns({"shard": shard, "slot": slot}).drop("__at")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write rows with ``shard`` and ``slot`` as one folder per shard, each file a range of slots in order."""
    ordered = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
