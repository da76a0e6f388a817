"""Exact duplicates by naming blocks.

Texts are cut into fixed-size blocks. Equal blocks get the same integer name, then equal groups of neighbouring names do,
level by level, until each document has one name. Documents that end on the same level with the same name are equal,
and no others are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import fitted, full_text, one_row_each, staged

BLOCK_BYTES = 4096
# Neighbouring names that get one name on the next level.
GROUP = 8


def _blocks(text: Column, block_bytes: int) -> Column:
    """The bytes of the text in pieces; an empty text is one empty piece."""
    data = F.encode(full_text(text), "UTF-8")
    last = F.call_function("div", F.greatest(F.octet_length(data) - 1, F.lit(0)), F.lit(block_bytes)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes))
    )


def _block_key(block: Column, attempt: int) -> Column:
    """128 bits under which a block travels. That no two blocks share a key is checked, not assumed."""
    return F.struct(F.xxhash64(F.lit(2 * attempt), block).alias("a"), F.xxhash64(F.lit(2 * attempt + 1), block).alias("b"))


def _named(rows: DataFrame, count: int, purpose: str) -> DataFrame:
    """``rows``, of which there are ``count`` at most, each with an integer of its own, 0 or more, as ``name``.

    They are written, which fixes the names.
    """
    return staged(fitted(rows, count).withColumn("name", F.monotonically_increasing_id()), purpose)


def document_names(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, block_key: Callable[[Column, int], Column] = _block_key
) -> DataFrame:
    """(row, doc_id, text_sha256, level, name) of every row: (level, name) is equal where the texts are.

    The text is shuffled once, to group the distinct blocks by content. Occurrences travel under a key of their block.
    Should two different blocks share a key, all is done again with other keys.
    """
    attempt = 0
    while True:
        keys = F.transform(_blocks(F.col("text"), block_bytes), lambda b: block_key(b, attempt))
        rows = staged(
            docs.select(
                F.monotonically_increasing_id().alias("row"),
                F.col("doc_id"),
                F.sha2(F.encode(full_text("text"), "UTF-8"), 256).alias("text_sha256"),
                keys.alias("keys"),
            ),
            "block-keys",
        )
        sizes = rows.agg(F.count(F.lit(1)), F.sum(F.size("keys")), F.max(F.size("keys"))).first()
        count, most, left = (n or 0 for n in sizes)
        blocks = docs.select(F.explode(_blocks(F.col("text"), block_bytes)).alias("block"))
        distinct = blocks.select(block_key(F.col("block"), attempt).alias("key"), "block").distinct()
        names = _named(distinct.groupBy("key").agg(F.count(F.lit(1)).alias("blocks")), most, "block-names")
        if names.filter("blocks > 1").isEmpty():
            break
        attempt += 1

    names = names.select("key.*", "name")
    at = rows.select("row", F.size("keys").alias("names"), F.posexplode("keys").alias("at", "key"))
    at = at.select("row", "names", "at", "key.*").join(names, ["a", "b"]).select("row", "names", "at", "name")
    parts = [f"part{i}" for i in range(GROUP)]
    finished, level = [], 0
    while True:
        if left > 1:
            at = staged(fitted(at, most), f"level-{level}")
        finished.append(at.filter("names = 1").select("row", F.lit(level).alias("level"), "name"))
        if left <= 1:
            break
        level, left, most = level + 1, -(-left // GROUP), most // 2  # of two names and more at most half as many are made
        place = F.col("at") % GROUP
        groups = at.filter("names > 1").groupBy("row", F.expr(f"cast(at div {GROUP} as int)").alias("at")).agg(
            F.expr(f"cast((max(names) + {GROUP - 1}) div {GROUP} as int)").alias("names"),
            *[F.coalesce(F.max(F.when(place == i, F.col("name"))), F.lit(-1)).alias(part) for i, part in enumerate(parts)],
        )
        groups = staged(fitted(groups, most), f"groups-{level}")
        names = _named(groups.select(parts).distinct(), most, f"names-{level}")
        at = groups.join(names, parts).select("row", "names", "at", "name")
    identities = finished[0]
    for more in finished[1:]:
        identities = identities.unionByName(more)
    return fitted(rows.drop("keys").join(identities, "row"), count)


def exact_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays (a null id is the smallest; of rows that repeat the id too,
    one stays). A null text counts as empty; empty texts are equal. An empty table gives no rows.
    """
    named = staged(document_names(docs, block_bytes), "document-names")
    groups = named.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    groups = staged(fitted(groups, named.count()), "equal-texts")
    return named.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with one row for each different text, all columns kept."""
    return one_row_each(docs, exact_copies(docs, block_bytes).filter("kept").select("doc_id", "text_sha256"))
