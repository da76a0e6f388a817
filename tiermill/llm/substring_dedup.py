"""Passages that repeat across documents: count-min prefilter, then exact grouping of the windows it lets through.

Documents are gathered into chunks. A chunk's sketch marks the cells of its windows in two rows of counters; it is sent in
slices, each to the task that adds up that range of cells over all chunks and answers which of the cells hold two
or more. A window whose cell does in both rows may repeat; no repeated window is missed. Chunks then send 128-bit
digests of just those windows, with the document they first occur in, and learn for each whether theirs is the
first occurrence of all. Sketch, chunks and answers grow with the corpus, but no task sees more than its slice of them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.llm.common import extended, giving_way, staged
from tiermill.llm.packed import ascended as _ascended
from tiermill.llm.packed import ascending as _ascending
from tiermill.llm.packed import cut as _cut
from tiermill.llm.packed import distinct
from tiermill.llm.packed import packed as _packed
from tiermill.llm.packed import unpacked as _unpacked
from tiermill.llm.words import words_in_pieces

WINDOW = 20
# Text gathered into a chunk; at 100 TB rather 256 MB, so that a chunk has something to send to each slice.
CHUNK_BYTES = 8 << 20
ROWS = 2
# Digests of repeated windows that one task compares.
DIGESTS_AT_ONCE = 1 << 22
# What stands for a null doc_id, and the columns that are added.
NO_ID = -(1 << 63)
ADDED = ("__n_words", "__n_removed", "__kept_sha256")
_POWERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


# --- chunks ---------------------------------------------------------------------------------------


def chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, window: int = WINDOW) -> DataFrame:
    """(chunk, windows, payload): the rows of ``docs`` gathered, sorted by doc_id and text and compressed, all columns kept."""
    text_at, id_at = (docs.columns.index(named(docs, name)) for name in ("text", "doc_id"))

    def pack(parts: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        ids = pc.fill_null(table.column(id_at).cast(pa.int64()), NO_ID).to_numpy()
        table = table.take(pa.array(np.lexsort((_ties(table.column(text_at)), ids))))
        windows = sum(max(0, _count(t.as_py()) - window + 1) for t in table.column(text_at))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_table(table)
        chunk = TaskContext.get().partitionId() << 32 | number
        payload = pa.array([sink.getvalue().to_pybytes()], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([windows]), payload], names=["chunk", "windows", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
            begin = 0
            for row, length in enumerate(lengths.tolist()):
                size += length + 64
                if size >= chunk_bytes:
                    held.append(batch.slice(begin, row + 1 - begin))
                    yield pack(held, number)
                    held, size, number, begin = [], 0, number + 1, row + 1
            if begin < batch.num_rows:
                held.append(batch.slice(begin))
        if held:
            yield pack(held, number)

    return docs.mapInArrow(run, "chunk bigint, windows bigint, payload binary")


def named(docs: DataFrame, name: str) -> str:
    """The column that Spark takes for ``name``: the one called so, or one in other case."""
    return name if name in docs.columns else next(c for c in docs.columns if c.lower() == name)


def _ties(texts: pa.ChunkedArray) -> np.ndarray:
    """What puts rows of one doc_id in order: 32 bits of a hash of the text, a null's the smallest."""
    return np.fromiter((xxhash.xxh3_64_intdigest(t.as_py().encode()) >> 33 if t.is_valid else -1 for t in texts), np.int32, len(texts))


def _count(text: str | None) -> int:
    return sum(map(len, words_in_pieces(text.encode()))) if text else 0


@dataclass
class Windows:
    """The windows of a chunk in order of (doc_id, text, start): two digests each, their first words, and the words per document."""

    table: pa.Table
    text_at: int
    id_at: int
    words: np.ndarray
    first: np.ndarray
    digests: tuple[np.ndarray, np.ndarray]

    @classmethod
    def of(cls, payload: bytes, plan: Plan) -> Windows:
        table, window = pa.ipc.open_stream(payload).read_all(), plan.window
        hashed, words = [], []
        for text in table.column(plan.text_at):
            text, count = text.as_py(), 0
            for some in words_in_pieces(text.encode()) if text else ():
                hashed.append(b"".join(map(xxhash.xxh3_128_digest, some)))
                count += len(some)
            words.append(count)
        words = np.array(words, np.int64)
        both = np.frombuffer(b"".join(hashed), "<u8").reshape(-1, 2)
        ends = np.cumsum(words)
        counts = np.maximum(words - window + 1, 0)
        first = np.repeat(ends - words - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        digests = tuple(_rolling(both[:, i], first, window, _POWERS[i]) for i in (0, 1))
        return cls(table, plan.text_at, plan.id_at, words, first, digests)

    def cells(self, row: int, width_bits: int) -> np.ndarray:
        return self.digests[row] >> np.uint64(64 - width_bits)


def _rolling(hashes: np.ndarray, first: np.ndarray, window: int, power: int) -> np.ndarray:
    """Digest of the hashes at first .. first + window - 1: a polynomial modulo 2**64, its bits mixed."""
    with np.errstate(over="ignore"):
        up, down = np.full(len(hashes) + 1, power, np.uint64), np.full(len(hashes) + 1, pow(power, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * np.cumprod(up)[:-1], dtype=np.uint64)])
        digest = (sums[first + window] - sums[first]) * np.cumprod(down)[first]
        for multiplier, shift in ((0xFF51AFD7ED558CCD, 33), (0xC4CEB9FE1A85EC53, 29)):
            digest = (digest ^ (digest >> np.uint64(shift))) * np.uint64(multiplier)
        return digest ^ (digest >> np.uint64(32))


# --- what chunks and slices send each other -------------------------------------------------------


def _bits(flags: np.ndarray) -> bytes:
    return zstandard.compress(np.packbits(flags).tobytes(), 1)


def _flags(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.decompress(data), np.uint8), count=count).astype(bool)


@dataclass(frozen=True)
class Plan:
    """Where id and text are, and sizes that follow from the number of windows: cells per row of the sketch, slices of cells and of digests."""

    text_at: int
    id_at: int
    window: int
    width_bits: int
    slice_bits: int
    digest_bits: int

    @classmethod
    def of(cls, windows: int, window: int, text_at: int = 1, id_at: int = 0) -> Plan:
        width_bits = max(16, math.ceil(math.log2(2 * max(windows, 1))))
        # a slice grows with the root of the sketch, as chunks should
        cell_bits = min(width_bits - 2, 22 + max(0, width_bits - 28) // 2)
        return cls(text_at, id_at, window, width_bits, width_bits - cell_bits, max(2, math.ceil(math.log2(max(windows, 1) / DIGESTS_AT_ONCE))))


def _ordered(cells: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells below 2**bits in rising order, and the place of each; sorted together as one number where they fit in it."""
    place_bits = max(len(cells) - 1, 1).bit_length()
    if bits + place_bits > 64:
        order = np.argsort(cells, kind="stable")
        return cells[order], order
    both = np.sort(cells << np.uint64(place_bits) | np.arange(len(cells), dtype=np.uint64))
    return both >> np.uint64(place_bits), (both & np.uint64((1 << place_bits) - 1)).astype(np.int64)


def _sketches(held: DataFrame, plan: Plan) -> DataFrame:
    """(slice, chunk, cells): each chunk's cells, by row and range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                windows = Windows.of(payload.as_py(), plan)
                for row in range(ROWS):
                    cells = distinct(windows.cells(row, plan.width_bits))
                    at = _cut(cells, plan.width_bits, plan.slice_bits)
                    slices = [i for i in range(1 << plan.slice_bits) if at[i] < at[i + 1]]
                    sent = [_ascending(cells[at[i] : at[i + 1]]) for i in slices]
                    keys = pa.array([row << plan.slice_bits | i for i in slices], pa.int64())
                    same = pa.array([chunk] * len(slices), pa.int64())
                    yield pa.RecordBatch.from_arrays([keys, same, pa.array(sent, pa.binary())], names=["slice", "chunk", "cells"])

    return held.select("chunk", "payload").mapInArrow(run, "slice bigint, chunk bigint, cells binary")


def _merged(sketches: DataFrame, plan: Plan) -> DataFrame:
    """(chunk, slice, flags): which of the cells a chunk sent are hit by two chunks or more."""
    size = 1 << plan.width_bits - plan.slice_bits

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(size, np.uint8)
        base = np.uint64((int(key[0]) & (1 << plan.slice_bits) - 1) * size)
        for sent in rows["cells"]:
            cells = _ascended(sent) - base  # a chunk names a cell once
            counts[cells] = np.minimum(counts[cells], 1) + 1
        flags = [_bits(counts[_ascended(sent) - base] > 1) for sent in rows["cells"]]
        return pd.DataFrame({"chunk": rows["chunk"], "slice": rows["slice"], "flags": flags})

    return sketches.groupBy("slice").applyInPandas(run, "chunk bigint, slice bigint, flags binary")


def _answers(rows: DataFrame, name: str) -> DataFrame:
    """One row per chunk with the flags of its slices in order; a chunk bounds them."""
    parts = F.sort_array(F.collect_list(F.struct("slice", F.col("flags"))))
    gathered = rows.groupBy("chunk").agg(parts.alias("parts"))
    return gathered.select("chunk", F.col("parts.slice").alias(f"{name}_slices"), F.col("parts.flags").alias(name))


def _candidates(windows: Windows, plan: Plan, slices: list[int], flags: list[bytes]) -> np.ndarray:
    """The windows whose estimated count is two or more."""
    answers = dict(zip(slices or [], flags or []))
    repeated = np.ones(len(windows.first), bool)
    for row in range(ROWS):
        ordered, order = _ordered(windows.cells(row, plan.width_bits), plan.width_bits)
        new = np.ones(len(ordered), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        begins = np.flatnonzero(new)
        cells, hits = ordered[begins], np.diff(np.append(begins, len(ordered)))
        at = _cut(cells, plan.width_bits, plan.slice_bits)
        shared = np.zeros(len(cells), bool)
        for i in range(1 << plan.slice_bits):
            if at[i] < at[i + 1]:
                shared[at[i] : at[i + 1]] = _flags(answers[row << plan.slice_bits | i], int(at[i + 1] - at[i]))
        here = np.empty(len(ordered), bool)
        here[order] = np.repeat(shared | (hits > 1), hits)
        repeated &= here
    return np.flatnonzero(repeated)


@dataclass
class Groups:
    """The different digests among a chunk's candidates, rising: members in order, where each group begins among them."""

    members: np.ndarray
    begins: np.ndarray

    @classmethod
    def of(cls, windows: Windows, candidates: np.ndarray) -> Groups:
        one, two = (d[candidates] for d in windows.digests)
        order = np.lexsort((two, one))  # stable: within a group by place
        one, two = one[order], two[order]
        new = np.ones(len(order), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        return cls(candidates[order], np.flatnonzero(new))

    def firsts(self) -> np.ndarray:
        return self.members[self.begins]


def _documents(windows: Windows, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """doc_id, a null as the smallest integer, and tie of the document each window lies in."""
    ids = pc.fill_null(windows.table.column(windows.id_at).cast(pa.int64()), NO_ID).to_numpy()
    at = np.searchsorted(np.cumsum(windows.words), windows.first[chosen], side="right")
    return ids[at], _ties(windows.table.column(windows.text_at))[at]


def _digests(asked: DataFrame, plan: Plan) -> DataFrame:
    """(slice, chunk, one, two, ids, ties): the digests of each chunk's candidates and the first document with each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk, payload, slices, flags = (batch.column(i)[row].as_py() for i in range(4))
                windows = Windows.of(payload, plan)
                firsts = Groups.of(windows, _candidates(windows, plan, slices, flags)).firsts()
                one, two = (d[firsts] for d in windows.digests)
                ids, ties = _documents(windows, firsts)
                at = _cut(one, 64, plan.digest_bits)
                used = [i for i in range(1 << plan.digest_bits) if at[i] < at[i + 1]]
                parts = [slice(at[i], at[i + 1]) for i in used]
                columns = [pa.array(used, pa.int64()), pa.array([chunk] * len(used), pa.int64())]
                sent = [(_ascending(one[p]), two[p].tobytes(), _packed(ids[p]), ties[p].tobytes()) for p in parts]
                columns += [pa.array([s[i] for s in sent], pa.binary()) for i in range(4)]
                yield pa.RecordBatch.from_arrays(columns, names=["slice", "chunk", "one", "two", "ids", "ties"])

    schema = "slice bigint, chunk bigint, one binary, two binary, ids binary, ties binary"
    return asked.select("chunk", "payload", "shared_slices", "shared").mapInArrow(run, schema)


def _earliest(digests: DataFrame) -> DataFrame:
    """(chunk, slice, flags): for which digests the chunk holds the first occurrence; equal doc_ids and texts go by chunk."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        one = [_ascended(x) for x in rows["one"]]
        sizes = [len(x) for x in one]
        one, two = np.concatenate(one), np.concatenate([np.frombuffer(x, "<u8") for x in rows["two"]])
        ids = np.concatenate([_unpacked(x, "<i8") for x in rows["ids"]])
        ties = np.concatenate([np.frombuffer(x, "<i4") for x in rows["ties"]])
        order = np.lexsort((ties, ids, two, one))  # stable: what is equal stays in order of the chunks
        new = np.ones(len(order), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        first = np.zeros(len(order), bool)
        first[order[new]] = True
        flags = [_bits(part) for part in np.split(first, np.cumsum(sizes)[:-1])]
        return pd.DataFrame({"chunk": rows["chunk"], "slice": rows["slice"], "flags": flags})

    return digests.groupBy("slice").applyInPandas(run, "chunk bigint, slice bigint, flags binary")


def _cut_texts(asked: DataFrame, plan: Plan, schema) -> DataFrame:
    """The documents without the words that a later occurrence covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                _, payload, shared_slices, shared, earliest_slices, earliest = (batch.column(i)[row].as_py() for i in range(6))
                windows = Windows.of(payload, plan)
                groups = Groups.of(windows, _candidates(windows, plan, shared_slices, shared))
                firsts, answers = groups.firsts(), dict(zip(earliest_slices or [], earliest or []))
                at = _cut(windows.digests[0][firsts], 64, plan.digest_bits)
                parts = [_flags(answers[i], int(at[i + 1] - at[i])) for i in range(1 << plan.digest_bits) if at[i] < at[i + 1]]
                kept = firsts[np.concatenate([np.zeros(0, bool), *parts])]
                gone = windows.first[np.setdiff1d(groups.members, kept, assume_unique=True)]
                edge = np.zeros(windows.words.sum() + plan.window + 1, np.int32)
                edge[gone] += 1  # a window begins once at a word
                edge[gone + plan.window] -= 1
                covered = np.cumsum(edge)[: windows.words.sum()] > 0
                yield from _without(windows, covered, schema)

    return asked.mapInArrow(run, schema)


def _without(windows: Windows, covered: np.ndarray, schema) -> Iterator[pa.RecordBatch]:
    texts, removed, sums, begin = [], [], [], 0
    for text, count in zip(windows.table.column(windows.text_at), windows.words.tolist()):
        text, gone, at = text.as_py(), covered[begin : begin + count], 0
        digest, kept = hashlib.sha256(), []
        for some in words_in_pieces(text.encode()) if text else ():
            part = b" ".join([w for w, g in zip(some, gone[at : at + len(some)].tolist()) if not g])
            at += len(some)
            if part:
                kept.append(part)
        joined = b" ".join(kept)
        digest.update(joined)
        removed.append(int(gone.sum()))
        sums.append(digest.hexdigest())
        texts.append(joined.decode() if removed[-1] else text)
        begin += count
    at = windows.text_at
    table = windows.table.set_column(at, windows.table.schema.names[at], pa.array(texts, pa.string()))
    for name, values in zip(ADDED, (pa.array(windows.words), pa.array(removed, pa.int64()), pa.array(sums, pa.string()))):
        table = table.append_column(name, values)
    yield from table.combine_chunks().to_batches()


# --- documents ------------------------------------------------------------------------------------


def cut_repeats(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` without the words that a window of ``window`` words covers whose words also occur earlier.

    Earlier means in a document of smaller doc_id (a null is the smallest), or before in the same document; rows that share a
    doc_id go by a hash of their text, whatever the order in which they are read, and of rows that share both any one is
    first. Windows are judged on the input. A text that loses words becomes the words that stay, joined by one space;
    other texts, null and empty ones too, stay as they are. All columns are kept, in their order; added are ``__n_words``,
    ``__n_removed`` and ``__kept_sha256`` (of the words that stay, joined by one space), to which columns of ``docs`` of such a
    name give way, with ``_in`` behind. Names may be in any case. An empty table gives no rows; a doc_id that is no integer
    is a ``TypeError``.
    """
    id_type = docs.schema[named(docs, "doc_id")].dataType
    if not isinstance(id_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"doc_id must be an integer, not {id_type.simpleString()}")
    docs = giving_way(docs, ADDED)
    held = staged(chunks(docs, chunk_bytes, window), "chunks")
    at = [docs.columns.index(named(docs, name)) for name in ("text", "doc_id")]
    plan = Plan.of(held.agg(F.sum("windows")).first()[0] or 0, window, *at)
    shared = staged(_merged(_sketches(held, plan), plan), "shared-cells")
    asked = held.drop("windows").join(_answers(shared, "shared"), "chunk", "left")
    earliest = staged(_earliest(_digests(asked, plan)), "first-windows")
    asked = asked.join(_answers(earliest, "earliest"), "chunk", "left")
    schema = extended(docs.schema, ", ".join(f"{n} {t}" for n, t in zip(ADDED, ("bigint", "bigint", "string"))))
    return _cut_texts(asked.select("chunk", "payload", "shared_slices", "shared", "earliest_slices", "earliest"), plan, schema)
