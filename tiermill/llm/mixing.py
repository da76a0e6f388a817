"""Mixing sources to target weights: which documents to take, and how often, so that every source comes to its target.

Documents have a fixed random place, a hash in hexadecimal digits. A source takes all its documents as often as its target
holds them in whole, and those below a threshold once more; a larger target moves the threshold up, so what a smaller one takes
stays taken. The threshold is found without a sort: words are summed by source and first digits, and only the bucket
in which the budget ends is divided by further digits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.common import full_text, staged

WEIGHTS = (5, 2, 1)
# Hexadecimal digits of a place, and after which of them buckets are refined: 4096 buckets, then as many in one of these.
DIGITS = 16
LEVELS = (3, 6, 9, 12, DIGITS)
# Bytes of all sources' rows up to which they are broadcast to the documents; more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
# Copies of one row that one task writes out.
COPIES_AT_ONCE = 100_000
_GAPS = r"\x20\x09-\x0D"


def word_count(text: Column) -> Column:
    """Number of words; the text becomes one letter per word, so no list of words is made."""
    begun = F.regexp_replace(text, f"^[{_GAPS}]++", "")
    return F.length(F.regexp_replace(begun, f"[^{_GAPS}]++[{_GAPS}]*+", "x")).cast("bigint")


def place(seed: int = 0, ids: str = "doc_id", text: str = "text") -> Column:
    """The fixed random place of a document, from its id and text."""
    return F.left(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(ids).cast("string"), F.col(text))), F.lit(DIGITS))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = 1.5, repeats: int = 2) -> DataFrame:
    """``sizes`` (key, source, source_size), one row per source, with the words to take of each.

    Sources, sorted, nulls last, weigh ``weights`` in turn and share ``budget`` times all words; none gets more than ``repeats``
    times its own, and what is left over goes to the others by weight. That is the level that all uncapped sources
    reach: with the sources sorted by cap over weight, the highest level that any of them allows if those before it are capped.
    Adds target, full (how often all documents are taken) and rest (words to take beyond that, fewer than source_size).

    Numbering the sources sorts one row per source in one task: sources are meant to be a list that a person keeps.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    numbered = sizes.withColumn("number", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weighed = numbered.withColumns({"weight": weight, "cap": F.col("source_size") * repeats})
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("number"))
    capped = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    words = F.sum("source_size").over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = (F.lit(float(budget)) * words - capped) / weight_left
    levelled = weighed.withColumn("level", level)
    highest = F.max("level").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("cap").cast("double"), F.col("weight") * highest)
    whole, own = F.floor(target + 0.5).cast("bigint"), F.greatest("source_size", F.lit(1).cast("bigint"))
    aimed = levelled.withColumns({"target": target, "full": F.call_function("div", whole, own), "rest": whole % own})
    return aimed.select("key", "source", "source_size", "target", "full", "rest")


def _ends(rows: DataFrame, budgets: DataFrame, digits: int, words: Column) -> DataFrame:
    """(key, edge, rest): the bucket of ``digits`` digits in which each source's budget ends, and what is left of it there."""
    sums = rows.groupBy("key", F.left("place", F.lit(digits)).alias("edge")).agg(F.sum(words).alias("words"))
    earlier = Window.partitionBy("key").orderBy("edge").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    left = F.col("rest") - F.col("before")
    return sums.join(budgets.select("key", "rest"), "key").filter((left >= 0) & (left < F.col("words"))).select("key", "edge", left.alias("rest"))


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = 1.5, repeats: int = 2, seed: int = 0
) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size (words), source_size, target (of its source) and taken (words).

    Targets are those of ``source_targets``. ``taken`` is size times how often the document is taken; the one document of a source at
    which its budget ends gives as many of its first words as are missing, so each source comes within a word of its target.
    The choice depends on the rows alone, not on files or partitions.

    A null text is empty and has no words to take; a null source is one of its own. Rows that repeat have the same place; they
    are counted, and the first of them taken whole, so that any number of them is no hot key. Other columns are not read. An
    empty table gives no rows.

    One scan of the texts writes (id, source, place, size); these are summed by source and bucket where they lie, and
    joined to one row per source, which is broadcast if all sources' rows are counted to be small.
    """
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    narrow = docs.select("doc_id", "source", key.alias("key"), place(seed).alias("place"), word_count(full_text()).alias("size"))
    held = staged(narrow, "mixing-sizes")
    sizes = held.groupBy("key", "source").agg(F.sum("size").cast("bigint").alias("source_size"))
    aims = staged(source_targets(sizes, weights, budget, repeats), "mixing-targets")

    width = aims.agg(F.coalesce(F.sum(F.octet_length("key") + 100), F.lit(0))).first()[0]

    def few(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if width <= BROADCAST_BYTES else rows

    # First over all rows, then over those of one bucket a source, its repeated rows counted.
    ends = staged(_ends(held, aims, LEVELS[0], F.col("size")), f"mixing-{LEVELS[0]}")
    inside = held.join(few(ends), (held["key"] == ends["key"]) & (F.left("place", F.lit(LEVELS[0])) == ends["edge"]), "left_semi")
    inside = staged(inside.groupBy(*inside.columns).agg(F.count(F.lit(1)).alias("copies")), "mixing-inside")
    for last, digits in zip(LEVELS, LEVELS[1:]):
        near = inside.join(ends.select("key", "edge"), "key").filter(F.left("place", F.lit(last)) == F.col("edge")).drop("edge")
        ends = staged(_ends(near, ends, digits, F.col("size") * F.col("copies")), f"mixing-{digits}")

    aims = aims.drop("source", "rest").join(ends, "key", "left")
    each = held.join(few(aims), "key").filter(F.col("edge").isNull() | (F.col("place") != F.col("edge")))
    more = F.when(F.col("place") < F.col("edge"), F.col("size")).otherwise(0)
    each = each.withColumn("more", more)
    result = ["doc_id", "source", "size", "source_size", "target", ((F.col("full") * F.col("size")) + F.col("more")).cast("bigint").alias("taken")]
    return each.select(*result).unionByName(_at_the_edge(inside.join(few(aims), "key").filter(F.col("place") == F.col("edge"))).select(*result))


def _at_the_edge(rows: DataFrame) -> DataFrame:
    """Rows (with ``copies``) at the place where the budget ends, each copy with its share ``more`` of ``rest``."""
    earlier = Window.partitionBy("key").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum(F.col("size") * F.col("copies")).over(earlier), F.lit(0))
    rows = rows.withColumn("left", F.col("rest") - taken)
    last_part = F.call_function("div", F.col("copies") - 1, F.lit(COPIES_AT_ONCE))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last_part))).repartition("key", "part")
    begin = F.col("part") * COPIES_AT_ONCE
    rows = rows.withColumn("copy", F.explode(F.sequence(begin, F.least(F.col("copies"), begin + COPIES_AT_ONCE) - 1)))
    return rows.withColumn("more", F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("copy") * F.col("size"))))


def mixed_texts(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The texts of a mix: a row (doc_id, copy, text) for every time a document is taken, its first words where it is taken in part.

    ``mixed`` comes from ``mix_sources`` over the same ``docs``, whose doc_ids must be unique for this.
    """
    wanted = mixed.filter("taken > 0").select(F.col("doc_id").alias("__id"), "size", "taken")
    joined = docs.join(wanted, F.col("doc_id") == F.col("__id"))
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.ceil(F.col("taken") / F.col("size"))))
    copies = joined.select("doc_id", "text", "size", "taken", copy.alias("copy"))
    words = F.least(F.col("size"), F.col("taken") - (F.col("copy") - 1) * F.col("size")).cast("int")
    some = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"[^{_GAPS}]+"), 0), F.lit(1), words), " ")
    return copies.select("doc_id", "copy", F.when(words == F.col("size"), F.col("text")).otherwise(some).alias("text"))
