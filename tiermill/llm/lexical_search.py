"""Ranked lexical search the other way round: documents stream through an index of the queries.

The queries (items) are few beside the documents, so the inverted index is over the items' terms: term -> (item, how often). Every task
gets it, runs its documents' term counts through it and keeps a bounded heap of the best documents per item; heaps are
then merged. More items than fit one index are searched in blocks, each against all documents.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.llm.common import staged
from tiermill.llm.words import words_in_pieces

BEST = 10
# (item, term) pairs of one index, but for an item that alone has more.
POSTINGS = 250_000
# Scores, and additions to scores, that a task holds at once.
CELLS = 1 << 18
ADDITIONS = 1 << 20
# Heaps of so many groups of tasks are merged first.
LANES = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# The same for UTF-8 bytes: letters A-Z fold, what is no part of a term becomes a space.
_FOLDED = bytes(b + 32 if chr(b) in UPPER else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_KEYS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Index:
    """Inverted index of one block of items; those of ``terms[t]`` are at ``starts[t]`` to ``starts[t + 1]``."""

    items: list[object]
    terms: list[bytes]
    starts: np.ndarray
    posted: np.ndarray
    repeats: np.ndarray

    @functools.cached_property
    def numbers(self) -> dict[bytes, int]:
        return {term: t for t, term in enumerate(self.terms)}


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term, repeats): the terms of every item, those of rows with the same item put together."""
    term = F.explode(F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(TERM), 0))
    terms = items.select(F.col(item).alias("item"), term.alias("term"))
    return terms.groupBy("item", "term").agg(F.count(F.lit(1)).alias("repeats"))


def _indexes(terms: DataFrame) -> Iterator[Index]:
    """The index of each block of items; only one block is on the driver at a time."""
    blocks = math.ceil(terms.count() / POSTINGS)
    for block in range(blocks):
        mine = terms.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block) if blocks > 1 else terms
        rows = mine.select("item", F.encode("term", "UTF-8").alias("term"), "repeats").orderBy("term", "item").collect()
        items = {item: i for i, item in enumerate(dict.fromkeys(r["item"] for r in rows))}
        counts = Counter(bytes(r["term"]) for r in rows)  # in the order of the rows
        starts = np.concatenate([[0], np.cumsum([*counts.values()], dtype=np.int64)])
        posted = np.array([items[r["item"]] for r in rows], np.int64)
        if rows:
            yield Index([*items], [*counts], starts, posted, np.array([r["repeats"] for r in rows], np.int64))


def term_counts(docs: DataFrame, terms: list[bytes], text: str = "text") -> DataFrame:
    """Per document with any term: doc_id, n (all its terms, with repeats), and which of ``terms`` it has, and how often each."""
    held = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: t for t, term in enumerate(held.value)}.get
        for batch in batches:
            rows, lengths, found, counts = [], [], [], []
            for row, value in enumerate(batch.column(1).cast(pa.binary())):
                n, counter = 0, Counter()
                for piece in words_in_pieces((value.as_py() or b"").translate(_FOLDED)):
                    n += len(piece)
                    counter.update(map(number, piece))
                if n:
                    counter.pop(None, None)
                    rows.append(row)
                    lengths.append(n)
                    found.append(list(counter))
                    counts.append(list(counter.values()))
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            lists = [pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([ids, pa.array(lengths, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", text)
    return narrow.mapInArrow(run, f"doc_id {id_type}, n bigint, terms array<int>, counts array<bigint>")


class Heaps:
    """The best ``size`` documents of each item so far: highest score first, equal ones by id, nulls last."""

    def __init__(self, items: int, size: int) -> None:
        self.size = size
        self.least = np.zeros(items, np.int64)  # a score below this one does not enter
        self.item, self.score, self.doc = (np.empty(0, np.int64) for _ in range(3))
        self.known = np.empty(0, bool)

    def update(self, scores: np.ndarray, docs: np.ndarray, known: np.ndarray) -> None:
        """Enter documents by their scores, a row per document and a column per item."""
        row, item = np.nonzero((scores > 0) & (scores >= self.least))
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[row, item]])
        doc, known = np.concatenate([self.doc, docs[row]]), np.concatenate([self.known, known[row]])
        order = np.lexsort((doc, ~known, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        best = order[rank < self.size]
        self.item, self.score, self.doc, self.known = item[rank < self.size], score[best], doc[best], known[best]
        full = rank == self.size - 1
        self.least[item[full]] = score[order[full]]


def _scored(index: Index, weights: np.ndarray, terms: np.ndarray, counts: np.ndarray, of: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores of documents (rows) for items (columns) from their term counts, ``of`` telling the document of each."""
    value = weights[terms] * ((1_000_000_000 * counts) // (1_000 * counts + 8 * m[of]))
    length = index.starts[terms + 1] - index.starts[terms]
    begin = np.cumsum(length) - length
    at = np.repeat(index.starts[terms] - begin, length) + np.arange(int(length.sum()))
    scores = np.zeros(len(m) * len(index.items), np.int64)
    np.add.at(scores, np.repeat(of * len(index.items), length) + index.posted[at], np.repeat(value, length) * index.repeats[at])
    return scores.reshape(len(m), len(index.items))


def best_documents(counted: DataFrame, index: Index, weights: list[int], item_type: T.DataType, best: int) -> DataFrame:
    """(item, doc_id, score): of each task's documents the ``best`` for every item. ``counted`` is (doc_id, m, terms, counts)."""
    spark, id_type = counted.sparkSession, counted.schema["doc_id"].dataType
    held = spark.sparkContext.broadcast((index, weights))
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weighed = held.value[0], np.array(held.value[1], np.int64)
        spread = np.diff(index.starts)
        heaps = Heaps(len(index.items), best)
        doc_type = None
        for batch in batches:
            ids, m, terms, counts = batch.columns
            doc_type = ids.type
            docs, known = ids.cast(pa.int64()).fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False)
            m, ends = m.to_numpy(), np.asarray(terms.offsets, np.int64) - terms.offsets[0].as_py()
            terms, counts = terms.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy()
            work = np.concatenate([[0], np.cumsum(spread[terms])])[ends]
            begin = 0
            while begin < len(m):
                end = int(np.searchsorted(work, work[begin] + ADDITIONS, "right")) - 1
                end = min(max(end, begin + 1), begin + max(CELLS // len(index.items), 1), len(m))
                some, rows = slice(ends[begin], ends[end]), slice(begin, end)
                of = np.repeat(np.arange(end - begin), np.diff(ends[begin : end + 1]))
                heaps.update(_scored(index, weighed, terms[some], counts[some], of, m[rows]), docs[rows], known[rows])
                begin = end
        if doc_type is not None:
            ids = pa.array(heaps.doc, pa.int64(), mask=~heaps.known).cast(doc_type)
            yield pa.RecordBatch.from_arrays([pa.array(heaps.item), ids, pa.array(heaps.score)], names=schema.names)

    items = T.StructType([T.StructField("n", T.LongType()), T.StructField("item", item_type)])
    items = F.broadcast(spark.createDataFrame([*enumerate(index.items)], items))  # one block's
    return counted.mapInArrow(run, schema).join(items, "n").select("item", "doc_id", "score")


def _first(rows: DataFrame, by: list[Column], best: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= best)


def search(docs: DataFrame, items: DataFrame, item: str = "item_id", text: str = "text", best: int = BEST) -> DataFrame:
    """(item, rank, doc_id, score): the ``best`` documents for each item with a score above 0, rank 1 the highest.

    Terms are the runs of letters, digits and characters beyond ASCII, A-Z folded. A term's weight falls with the number of
    documents that hold it, its part in a score rises with its count there and falls with the document's length; all in
    integers. Equal scores go by ascending doc_id, which must be an integer; nulls come last. Every row of ``docs`` is a document, also
    where it repeats; rows of ``items`` with the same id, nulls too, are one item of all their terms. Null and empty texts have no
    terms: such a document is not counted, such an item finds nothing, nor does any in an empty table. Other columns are not
    read. Scores and 1,000,000,000 times a term's count in a document must stay below 2^63.

    Of the items, one block's index at a time is on the driver and in each worker: POSTINGS pairs of item and term. Documents pass once
    per block; what the block needs of them, the counts of its terms, is written and read twice. A task holds ``best``
    documents per item of the block, and they are merged in two steps, so that no task sees more than a few hundred
    times that.
    """
    if not isinstance(docs.schema["doc_id"].dataType, _KEYS):
        raise TypeError(f"doc_id must be an integer, not {docs.schema['doc_id'].dataType.simpleString()}")
    spark, item_type = docs.sparkSession, items.schema[item].dataType
    terms = staged(item_terms(items, item, text), "item-terms")
    found = spark.createDataFrame([], T.StructType([
        T.StructField("item", item_type), T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.LongType())
    ]))
    for index in _indexes(terms):
        counted = staged(term_counts(docs, index.terms, text), "term-counts")
        documents, length = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("documents"))
        weights = [0] * len(index.terms)
        for term, holds in holding.collect():  # a row per term of the block at most
            weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * holds + 1)))
        share = F.call_function("div", (F.col("n") * 75).cast("decimal(38,0)") * documents, F.lit(max(length, 1)).cast("decimal(38,0)"))
        lengths = counted.select("doc_id", (share + 25).cast("bigint").alias("m"), "terms", "counts")
        found = found.unionByName(best_documents(lengths, index, weights, item_type, best))
    lane = F.pmod(F.spark_partition_id(), F.lit(LANES))
    merged = _first(_first(found.withColumn("lane", lane), ["item", "lane"], best), ["item"], best)
    return merged.select(F.col("item").alias(item), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
