"""Packing token sequences: shortest pack first, over the histogram of lengths.

The histogram has one count per length up to the capacity, so the packing itself is a small computation however large the
corpus is. It yields patterns, such as 700 + 200 + 124 tokens, with how often each is used. Pieces are then numbered
within their length, and a piece's number tells its pattern, sequence and place.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.bpe import encoder
from tiermill.llm.common import staged
from tiermill.llm.vocabulary import SPLIT, parsed, share

CAPACITY = 1024
END_ID = 0
# Pieces of one length that one task numbers.
NUMBERED_AT_ONCE = 250_000
# Copies of one piece that one task writes out.
COPIES_AT_ONCE = 100_000


@dataclass(frozen=True)
class Pattern:
    """Lengths that share a sequence, longest first, and how many sequences are filled so."""

    lengths: tuple[int, ...]
    count: int


def pack_histogram(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold every length as often as ``histogram`` says.

    Lengths are placed longest first, many at a time. Each goes to the pack that is shortest so far; if
    it does not fit there, it fits nowhere and opens new packs. Many packs change at once: a step uses up either the length or a kind of
    pack, so there are at most twice as many steps as kinds of packs.
    """
    packs: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # tokens used -> kinds of packs with their counts
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not within 1 to {capacity}")
        while left > 0:
            shortest = min(packs, default=capacity)
            if shortest + length > capacity:
                each = capacity // length  # a new pack stays the shortest until it is full
                for lengths, count in (((length,) * each, left // each), ((length,) * (left % each), 1)):
                    if lengths and count:
                        packs.setdefault(length * len(lengths), []).append((lengths, count))
                break
            lengths, count = packs[shortest].pop()
            used = min(left, count)
            if count > used:
                packs[shortest].append((lengths, count - used))
            elif not packs[shortest]:
                del packs[shortest]
            packs.setdefault(shortest + length, []).append(((*lengths, length), used))
            left -= used
    return [Pattern(lengths, count) for used in sorted(packs) for lengths, count in packs[used]]


def placements(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, rank after the last, pieces per sequence, first sequence, offset of the first)."""
    rows, ranked, sequence = [], {}, 0
    for pattern in patterns:
        offset = 0
        for length in sorted(set(pattern.lengths), reverse=True):
            each = pattern.lengths.count(length)
            first = ranked.get(length, 0)
            ranked[length] = first + each * pattern.count
            rows.append((length, first, ranked[length], each, sequence, offset))
            offset += each * length
        sequence += pattern.count
    return rows


@functools.lru_cache(maxsize=2)
def _tokenizer(data: bytes) -> tiktoken.Encoding:
    """The vocabulary in the library that encodes it fastest; tests hold its ids against the file's own library."""
    vocabulary = parsed(data)
    ranks = [merged for _, merged in sorted(vocabulary.merges.values())]
    if ranks != sorted(ranks):
        raise ValueError("the ids do not follow the merges")
    return tiktoken.Encoding(
        "file",
        pat_str=SPLIT,
        mergeable_ranks={token: i for i, token in vocabulary.tokens.items()},
        special_tokens=vocabulary.special,
    )


def _ids(tokenizer: tiktoken.Encoding, data: bytes, text: str) -> np.ndarray:
    try:
        return tokenizer.encode_to_numpy(text, allowed_special="all")
    except ValueError:  # a run of millions of spaces is too much for its pattern matching
        return encoder(data).encode(text)


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Each document's ids and ``end_id``, cut into pieces of ``capacity`` and a rest: doc_id, start, length,
    ids_crc32, doc_tokens, and the ids themselves as little-endian bytes if asked for.
    """
    held = share(docs.sparkSession, vocabulary)
    schema = "doc_id {}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint".format(
        docs.schema["doc_id"].dataType.simpleString()
    )
    if with_ids:
        schema += ", ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(held.value)
        for batch in batches:
            rows, starts, lengths, sums, totals, pieces = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = _ids(tokenizer, held.value, text.as_py() or "")
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity].tobytes()
                    rows.append(row)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(len(ids))
                    if with_ids:
                        pieces.append(piece)
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in (starts, lengths, sums, totals)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns, names = [*columns, pa.array(pieces, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, start, length, ids_crc32 and more) with their ``sequence_id`` and ``offset``.

    Equal pieces are interchangeable; the result depends on the rows alone. They are counted before they are numbered, so a
    piece repeated any number of times is no hot key. ``pieces`` is read once.
    """
    spark, columns = pieces.sparkSession, pieces.columns
    pieces = staged(pieces.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies")), "counted-pieces")
    sizes = pieces.groupBy("length").agg(F.sum("__copies").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()
    table = placements(pack_histogram({r["length"]: r["n"] for r in sizes}, capacity))
    slots = spark.createDataFrame(
        table, "length bigint, first bigint, behind bigint, each bigint, first_sequence bigint, first_offset bigint"
    )
    # a frequent length is numbered in so many hashed parts that each is small
    parts = [(r["length"], 1 + r["kinds"] // NUMBERED_AT_ONCE) for r in sizes]
    parts = spark.createDataFrame(parts, "length bigint, parts bigint")
    identity = ["doc_id", "start", "ids_crc32"]
    dealt = pieces.join(F.broadcast(parts), "length").withColumn("part", F.pmod(F.xxhash64(*identity), "parts")).drop("parts")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("length", "part").agg(F.sum("__copies").alias("n"))
    before = before.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = identity + [c for c in columns if c not in identity]
    within = Window.partitionBy("length", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumn("rank", F.coalesce(F.sum("__copies").over(within), F.lit(0)))
    ranked = ranked.join(F.broadcast(before), ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
    ranked = _each_copy(ranked).withColumnRenamed("length", "piece_length")
    here = (F.col("piece_length") == F.col("length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("behind"))
    nth = F.col("rank") - F.col("first")
    placed = ranked.join(F.broadcast(slots), here).withColumns(
        {
            "sequence_id": F.col("first_sequence") + F.call_function("div", nth, F.col("each")),
            "offset": F.col("first_offset") + nth % F.col("each") * F.col("length"),
        }
    )
    return placed.select(*columns, F.col("sequence_id").cast("bigint"), F.col("offset").cast("bigint"))


def _each_copy(ranked: DataFrame) -> DataFrame:
    """A row for each of the ``__copies`` of a row, ``rank`` counted on; of very many copies a task makes a bounded number."""
    few = ranked.filter(F.col("__copies") <= COPIES_AT_ONCE).withColumn("__share", F.lit(0).cast("bigint"))
    last = F.call_function("div", F.col("__copies") - 1, F.lit(COPIES_AT_ONCE))
    many = ranked.filter(F.col("__copies") > COPIES_AT_ONCE)
    many = many.withColumn("__share", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).repartition("__share")
    begin = F.col("__share") * COPIES_AT_ONCE
    copy = F.explode(F.sequence(begin, F.least(F.col("__copies"), begin + COPIES_AT_ONCE) - 1))
    each = few.unionByName(many).withColumn("__copy", copy)
    return each.withColumn("rank", F.col("rank") + F.col("__copy"))


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``capacity`` tokens.

    A null text counts as empty: its document is the end id alone. Repeated rows are packed each. An empty table gives
    no rows. Texts are encoded once; the pieces are written to the shared folder.
    """
    return place_pieces(token_pieces(docs, vocabulary, capacity, end_id, with_ids), capacity)


def packed_sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, tokens, ids): the ids of each sequence in order, from pieces placed ``with_ids``, without padding."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))  # bounded by the capacity
    joined = placed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), parts.alias("parts"))
    return joined.select("sequence_id", "tokens", F.unhex(F.concat_ws("", "parts.ids")).alias("ids"))
