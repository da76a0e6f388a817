"""Log-probabilities of texts under a hashed maximum-entropy model with a class-factored softmax.

Words fall into hashed buckets and buckets into classes of words that keep the same company.
The probability of a word is that of its class given what is before it, times that of its bucket given the class and the class before
it, times its share of the bucket by smoothed counts:

* the class by a softmax over weights of hashed features: the word before, the one before that (a skip), the ending of the
  word before, which is all that is known of a rare word, and both words together;
* the bucket by a softmax within the class, over weights of (class before, bucket).

The first three features have a table of a fixed size, which every task holds. Pairs of words have as many weights as there are
pairs and classes behind them in the corpus; they are sharded by pair. Texts are cut into words once and gathered into chunks. A chunk
sends its counts of (pair, class) in slices, each to the task that adds up that range of pairs over all chunks. A pair
tells the other features too, so that task has all it needs for gradient steps on different contexts in place of tokens: on the
tables in rounds, each slice's changes averaged by how often it has seen a feature, and at last on the weights of its own pairs.
It answers every chunk with the log-chances of what it sent. Token counts are exchanged in the same way.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import full_text, staged
from tiermill.llm.embedding_dedup import spherical_centres
from tiermill.llm.packed import ascended, ascending, cut, narrow, packed, unpacked, widened
from tiermill.llm.words import words_in_pieces

ALPHA = 0.1
BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
CLASS_BITS = 5
CLASSES = 1 << CLASS_BITS
MARKERS = 64
# Rows of the table for the word before, the one before that, and the ending of the word before.
ROW_BITS = 12
FEATURES = (1 << ROW_BITS,) * 3
ENDING, ENDING_BITS = 4, ROW_BITS
# Bits of a pair's own hash, beside its rows in the table: this much below those of the number of tokens.
FEWER_BITS, MOST_BITS = 14, 22
ROUNDS = 3
BATCH = 1 << 14
RATE = 0.3
# A pair's weight of a class is held towards nothing as by so many occurrences; steps to find it.
PRIOR, STEPS = 0.25, 12
# Text gathered into a chunk, and tokens whose pairs one task adds up; both grow with the corpus as its root.
CHUNK_BYTES = 8 << 20
SLICE_TOKENS = 1 << 22
# Different tokens of a chunk, all chunks together, that one task adds up.
SLICE_WORDS = 1 << 20
# Log-chances travel in steps of 2**-12.
FRACTION = 1 << 12
END = b""
# Partial results that one task adds up.
ADDED_AT_ONCE = 256


# --- tokens ---------------------------------------------------------------------------------------


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _tokens(text: str) -> Iterator[list[bytes]]:
    """Lower-cased words (A to Z only) in lists of a bounded size, the last of which ends with the end."""
    last: list[bytes] = []
    for some in words_in_pieces(text.encode().lower()):
        if last:
            yield last
        last = some
    last.append(END)
    yield last


def _whole(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


def _endings(words: list[bytes]) -> np.ndarray:
    return np.array([zlib.crc32(w[-ENDING:]) & ((1 << ENDING_BITS) - 1) for w in words], np.uint16)


def _with_ending(whole: np.ndarray, endings: np.ndarray) -> np.ndarray:
    """Hash of each whole word in the upper bits, and of its ending in the lower ENDING_BITS."""
    return (whole & ~np.uint64((1 << ENDING_BITS) - 1)) | endings.astype(np.uint64)


def _hashes(words: list[bytes]) -> np.ndarray:
    return _with_ending(_whole(words), _endings(words))


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _contexts(before: np.ndarray, skipped: np.ndarray, bits: int) -> np.ndarray:
    """A pair of words in one number: ``bits`` of its hash, then its rows for the word before, the one before that, and the ending."""
    with np.errstate(over="ignore"):
        both = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (skipped * np.uint64(0xC2B2AE3D27D4EB4F))
        both = (both ^ (both >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
    low, shift = np.uint64((1 << ROW_BITS) - 1), np.uint64(20)
    key = both >> np.uint64(64 - bits)
    for row in ((before >> shift) & low, (skipped >> shift) & low, before & low):
        key = key << np.uint64(ROW_BITS) | row
    return key


def _rows(contexts: np.ndarray) -> list[np.ndarray]:
    """Rows of the table for each context: those of the features one behind the other."""
    low = np.uint64((1 << ROW_BITS) - 1)
    shifts = (2 * ROW_BITS, ROW_BITS, 0)
    return [((contexts >> np.uint64(s)) & low).astype(np.int64) + i * FEATURES[0] for i, s in enumerate(shifts)]


def _features(hashes: np.ndarray) -> list[np.ndarray]:
    """What is active before each token from the third on: rows of the word before, of the one before that, the pair, the ending's row."""
    contexts = _contexts(hashes[1:-1], hashes[:-2], MOST_BITS)
    before, skipped, ending = _rows(contexts)
    return [before, skipped, contexts, ending]


# --- chunks ---------------------------------------------------------------------------------------


_CHUNK = "chunk bigint, tokens bigint, kinds bigint, docs binary, words binary, endings binary, counts binary, ids binary"
_LOADED = ("docs", "words", "endings", "counts", "ids")


def _by_count(counts: np.ndarray) -> np.ndarray:
    return np.argsort(-counts, kind="stable")


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of (doc_id, held_out, text) gathered: a chunk's rows, its different words, how often each is in training texts, and its tokens.

    Words are told apart by 64 bits of hash; hashes are sent with their endings, by 76.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        found: list[tuple[np.ndarray, np.ndarray]] = []  # words as numbers take a sixth of the memory
        lengths: list[int] = []
        size, number = 0, 0

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches(parts)
            held = rows.column(1).combine_chunks().to_numpy(zero_copy_only=False)
            kinds, first, ids = np.unique(np.concatenate([w for w, _ in found]), return_index=True, return_inverse=True)
            endings = np.concatenate([e for _, e in found])[first]
            counts = np.bincount(ids[np.repeat(~held, lengths)], minlength=len(kinds))
            rows = rows.append_column("length", pa.array(lengths, pa.int64())).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(rows)
            chunk = TaskContext.get().partitionId() << 32 | number
            numbers = [pa.array([n], pa.int64()) for n in (chunk, len(ids), len(kinds))]
            rank = np.empty(len(kinds), np.int64)
            rank[_by_count(counts)] = np.arange(len(kinds))  # frequent words get small numbers, which pack well
            data = (sink.getvalue().to_pybytes(), ascending(kinds), packed(endings), narrow(counts), narrow(rank[ids]))
            names = [f.split()[0] for f in _CHUNK.split(", ")]
            return pa.RecordBatch.from_arrays([*numbers, *[pa.array([d], pa.binary()) for d in data]], names=names)

        for batch in batches:
            bytes_of, begin = pc.binary_length(batch.column(2)).to_pylist(), 0
            for row, text in enumerate(batch.column(2)):
                mine = [(_whole(some), _endings(some)) for some in _tokens(text.as_py())]
                found += mine
                lengths.append(sum(len(w) for w, _ in mine))
                size += bytes_of[row] + 64
                if size >= chunk_bytes:
                    parts.append(batch.slice(begin, row + 1 - begin).select([0, 1]))
                    yield flush()
                    parts, found, lengths, size, number, begin = [], [], [], 0, number + 1, row + 1
            if begin < batch.num_rows:
                parts.append(batch.slice(begin).select([0, 1]))
        if parts:
            yield flush()

    return docs.mapInArrow(run, _CHUNK)


@dataclass
class Chunk:
    """The tokens of a chunk by their hashes, and those before them (nothing before a text begins)."""

    docs: pa.Table
    ids: np.ndarray
    lengths: np.ndarray
    here: np.ndarray
    before: np.ndarray
    skipped: np.ndarray
    training: np.ndarray

    @classmethod
    def of(cls, docs: bytes, words: bytes, endings: bytes, counts: bytes, ids: bytes) -> Chunk:
        table, ids = pa.ipc.open_stream(docs).read_all(), _by_count(widened(counts))[widened(ids)]
        lengths = table.column("length").to_numpy()
        here = _with_ending(ascended(words), unpacked(endings, "<u2"))[ids]
        before, skipped = np.zeros_like(here), np.zeros_like(here)
        before[1:], skipped[2:] = here[:-1], here[:-2]
        starts = np.cumsum(lengths) - lengths
        before[starts] = skipped[starts] = 0
        skipped[starts[lengths > 1] + 1] = 0
        held = table.column(1).combine_chunks().to_numpy(zero_copy_only=False)
        return cls(table, ids, lengths, here, before, skipped, np.repeat(~held, lengths))

    @property
    def follows(self) -> np.ndarray:
        """Which training tokens have one before them."""
        first = np.zeros(len(self.ids), bool)
        first[np.cumsum(self.lengths) - self.lengths] = True
        return self.training & ~first

    def keys(self, classes: np.ndarray, bits: int) -> np.ndarray:
        """Context and class of each token in one number."""
        return _contexts(self.before, self.skipped, bits) << np.uint64(CLASS_BITS) | classes[_buckets(self.here)].astype(np.uint64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield Chunk.of(*(batch.column(c)[row].as_py() for c in _LOADED))


# --- token counts ---------------------------------------------------------------------------------


def token_totals(chunks: DataFrame, slice_bits: int) -> DataFrame:
    """(slice, words, totals, chunks, answers): each slice's words with their counts over all chunks, and those of each chunk's words in its order."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk, words, endings, counts = (batch.column(i)[row].as_py() for i in range(4))
                words, endings, counts = ascended(words), unpacked(endings, "<u2"), widened(counts)
                at = cut(words, 64, slice_bits)
                used = [s for s in range(1 << slice_bits) if at[s] < at[s + 1]]
                parts = [slice(at[s], at[s + 1]) for s in used]
                columns = [pa.array(used, pa.int64()), pa.array([chunk] * len(used), pa.int64())]
                sent = [(ascending(words[p]), packed(endings[p]), narrow(counts[p])) for p in parts]
                columns += [pa.array([s[i] for s in sent], pa.binary()) for i in range(3)]
                yield pa.RecordBatch.from_arrays(columns, names=["slice", "chunk", "words", "endings", "counts"])

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        sent = [ascended(w) for w in rows["words"]]
        words, endings = np.concatenate(sent), np.concatenate([unpacked(e, "<u2") for e in rows["endings"]])
        order = np.lexsort((endings, words))
        new = np.ones(len(order), bool)
        new[1:] = (words[order][1:] != words[order][:-1]) | (endings[order][1:] != endings[order][:-1])
        begins = np.flatnonzero(new)
        totals = np.add.reduceat(np.concatenate([widened(c) for c in rows["counts"]])[order], begins)
        each = np.empty(len(order), np.int64)
        each[order] = totals[np.cumsum(new) - 1]
        answers = [narrow(part) for part in np.split(each, np.cumsum([len(w) for w in sent])[:-1])]
        merged = {"slice": [int(key[0])], "words": [ascending(words[order][begins])], "totals": [narrow(totals)]}
        return pd.DataFrame(merged | {"chunks": [rows["chunk"].tolist()], "answers": [answers]})

    sent = chunks.select("chunk", "words", "endings", "counts")
    sent = sent.mapInArrow(send, "slice bigint, chunk bigint, words binary, endings binary, counts binary")
    schema = "slice bigint, words binary, totals binary, chunks array<bigint>, answers array<binary>"
    return sent.groupBy("slice").applyInPandas(add, schema)


def _by_chunk(rows: DataFrame, name: str) -> DataFrame:
    """(chunk, ``name``): the answers that slices (slice, chunks, answers) have for each chunk, by slice; a chunk bounds them."""
    each = rows.select("slice", F.explode(F.arrays_zip("chunks", "answers")).alias("to"))
    parts = F.sort_array(F.collect_list(F.struct("slice", F.col("to.answers").alias("answer"))))
    return each.groupBy(F.col("to.chunks").alias("chunk")).agg(parts.alias("parts")).select("chunk", F.col("parts.answer").alias(name))


# --- sums -----------------------------------------------------------------------------------------

_SENT = "task bigint, part int, sums binary"
_PARTS = 16


def _sent(array: np.ndarray, parts: int, task: int | None = None) -> pa.RecordBatch:
    pieces = [p.astype(np.float32).tobytes() for p in np.split(array.ravel(), parts)]
    task = TaskContext.get().partitionId() if task is None else task
    return pa.RecordBatch.from_arrays(
        [pa.array([task] * parts, pa.int64()), pa.array(range(parts), pa.int32()), pa.array(pieces, pa.binary())], names=["task", "part", "sums"]
    )


def _added(rows: DataFrame, size: int, tasks: int) -> np.ndarray:
    """Sum of the arrays of 32-bit floats in ``rows`` (task, part, sums), each part of which has ``size`` numbers, part by part.

    Added up in as many steps as ``tasks`` arrays of a part ask for, so that no task gets more than some hundreds of them. The
    arrays of a group are added in order of their tasks.
    """

    def run(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size, np.float64)
        for sums in some.sort_values("task")["sums"]:
            total += np.frombuffer(sums, np.float32)
        return pd.DataFrame({"task": [int(key[0])], "part": [int(key[1])], "sums": [total.astype(np.float32).tobytes()]})

    for _ in range(max(1, math.ceil(math.log(max(tasks, 2), ADDED_AT_ONCE)))):
        group = F.call_function("div", F.col("task"), F.lit(ADDED_AT_ONCE))
        rows = rows.withColumn("group", group).groupBy("group", "part").applyInPandas(run, _SENT)
    parts: dict[int, np.ndarray] = {}
    for r in rows.orderBy("task", "part").collect():  # as large as the model
        sums = np.frombuffer(r["sums"], np.float32)
        parts[r["part"]] = parts[r["part"]] + sums if r["part"] in parts else sums
    return np.concatenate([parts[i] for i in sorted(parts)]) if parts else np.zeros(0, np.float32)


# --- the model ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Class of each bucket, weights and bias of the classes, and log-chances of buckets within their class by class before."""

    classes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    within: np.ndarray
    mass: np.ndarray

    def class_chances(self, rows: list[np.ndarray]) -> np.ndarray:
        """Chances of the classes by the table's features alone; of ``_features``, the pair has no part in them."""
        rows = [rows[0], rows[1], rows[-1]]
        odds = self.weights[rows[0]] + self.bias
        for more in rows[1:]:
            odds += self.weights[more]
        odds -= odds.max(axis=1, keepdims=True)
        np.exp(odds, out=odds)
        odds /= odds.sum(axis=1, keepdims=True)
        return odds


def _classes(mass: np.ndarray, company: np.ndarray) -> np.ndarray:
    """Buckets into classes by spherical k-means over what stands before and after them."""
    expected = company.sum(axis=1, keepdims=True) * company.sum(axis=0, keepdims=True) / max(company.sum(), 1)
    profile = np.log1p(company) - np.log1p(expected)
    length = np.sqrt((profile * profile).sum(axis=1, keepdims=True))
    units = np.where(length > 0, profile / np.maximum(length, 1e-9), 1 / math.sqrt(profile.shape[1]))
    heavy = np.argsort(-mass, kind="stable")[: 64 * CLASSES]
    centres = spherical_centres(units[heavy], CLASSES)
    return (units @ centres.T).argmax(axis=1)


def _company(chunks: DataFrame, markers: np.ndarray, tasks: int) -> np.ndarray:
    """How often each bucket stands right behind or before each of the marking buckets."""
    marker_of = np.full(BUCKETS, len(markers))
    marker_of[markers] = np.arange(len(markers))
    width = 2 * len(markers) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS * width, np.int64)
        for chunk in _chunks(batches):
            real = chunk.follows
            left, right = _buckets(chunk.before[real]), _buckets(chunk.here[real])
            sums += np.bincount(right * width + marker_of[left], minlength=len(sums))
            sums += np.bincount(left * width + len(markers) + 1 + marker_of[right], minlength=len(sums))
        if sums.any():
            yield _sent(sums, _PARTS)

    found = _added(chunks.select(*_LOADED).mapInArrow(run, _SENT), BUCKETS * width // _PARTS, tasks)
    found = found.reshape(-1, width) if len(found) else np.zeros((BUCKETS, width))
    return np.delete(found, [len(markers), width - 1], axis=1)


def _followers(chunks: DataFrame, classes: np.ndarray, tasks: int) -> np.ndarray:
    """How often each bucket stands behind each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(CLASSES * BUCKETS, np.int64)
        for chunk in _chunks(batches):
            before, here = (_buckets(h[chunk.training]) for h in (chunk.before, chunk.here))
            sums += np.bincount(classes[before] * BUCKETS + here, minlength=len(sums))
        if sums.any():
            yield _sent(sums, _PARTS)

    found = _added(chunks.select(*_LOADED).mapInArrow(run, _SENT), CLASSES * BUCKETS // _PARTS, tasks)
    return found.reshape(CLASSES, BUCKETS) if len(found) else np.zeros((CLASSES, BUCKETS), np.float32)


def _within(counts: np.ndarray, mass: np.ndarray, classes: np.ndarray, steps: int = 60) -> np.ndarray:
    """log10 of each bucket's probability within its class, by class before; gradient steps on the counts.

    The steps are scaled by how often a context occurs and are held back towards the shares by mass.
    """
    share = np.bincount(classes, mass, CLASSES)
    base = np.log(mass) - np.log(share[classes])
    result = np.zeros_like(counts, dtype=np.float32)
    for before in range(len(counts)):
        n, extra = counts[before].astype(np.float64), np.zeros(len(base))
        whole = np.bincount(classes, n, CLASSES)[classes]
        for _ in range(steps):
            odds = np.exp(np.minimum(base + extra, 50))
            chance = odds / np.bincount(classes, odds, CLASSES)[classes]
            slope = n - whole * chance - extra
            extra += slope / (np.maximum(whole * chance, n) + 1) * 0.7
        odds = np.exp(np.minimum(base + extra, 50))
        result[before] = np.log10(odds / np.bincount(classes, odds, CLASSES)[classes])
    return result


# --- contexts, sharded ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """Bits of a pair's own hash, and slices of contexts, both from the number of tokens."""

    pair_bits: int
    slice_bits: int

    @classmethod
    def of(cls, tokens: int) -> Plan:
        size = math.log2(max(tokens, 1))
        # a slice grows with the root of the corpus, as chunks should
        slice_bits = max(2, math.ceil(size - math.log2(SLICE_TOKENS) - max(0.0, size - 34) / 2))
        return cls(min(MOST_BITS, max(slice_bits, math.ceil(size) - FEWER_BITS)), slice_bits)

    @property
    def key_bits(self) -> int:
        return self.pair_bits + 3 * ROW_BITS + CLASS_BITS


def shared_contexts(chunks: DataFrame, classes: np.ndarray, plan: Plan) -> DataFrame:
    """(slice, keys, counts, chunks, places): the different (context, class) of a slice with their counts in
    training texts, and where those of each chunk are among them."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = Chunk.of(*(batch.column(c)[row].as_py() for c in _LOADED))
                both = np.sort(chunk.keys(classes, plan.pair_bits) << np.uint64(1) | chunk.training.astype(np.uint64))
                keys = both >> np.uint64(1)
                begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                keys, counts = keys[begins], np.add.reduceat((both & np.uint64(1)).astype(np.int64), begins)
                at = cut(keys, plan.key_bits, plan.slice_bits)
                used = [s for s in range(1 << plan.slice_bits) if at[s] < at[s + 1]]
                columns = [pa.array(used, pa.int64()), pa.array([batch.column("chunk")[row].as_py()] * len(used), pa.int64())]
                columns += [pa.array([ascending(keys[at[s] : at[s + 1]]) for s in used], pa.binary())]
                columns += [pa.array([narrow(counts[at[s] : at[s + 1]]) for s in used], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["slice", "chunk", "keys", "counts"])

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        sent = [ascended(k) for k in rows["keys"]]
        keys, counts = np.concatenate(sent), np.concatenate([widened(c) for c in rows["counts"]])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[begins], np.add.reduceat(counts[order], begins)
        places = [ascending(np.searchsorted(keys, k).astype(np.uint64)) for k in sent]
        return pd.DataFrame(
            {"slice": [int(key[0])], "keys": [ascending(keys)], "counts": [narrow(counts)], "chunks": [rows["chunk"].tolist()], "places": [places]}
        )

    sent = chunks.select("chunk", *_LOADED).mapInArrow(send, "slice bigint, chunk bigint, keys binary, counts binary")
    return sent.groupBy("slice").applyInPandas(add, "slice bigint, keys binary, counts binary, chunks array<bigint>, places array<binary>")


@dataclass
class Contexts:
    """Different contexts with the classes seen behind them, an entry each; of which context it is, and where a context's entries begin."""

    contexts: np.ndarray
    begins: np.ndarray
    of: np.ndarray
    classes: np.ndarray
    counts: np.ndarray

    @classmethod
    def from_keys(cls, keys: np.ndarray, counts: np.ndarray) -> Contexts:
        contexts = keys >> np.uint64(CLASS_BITS)
        new = np.ones(len(keys), bool)
        new[1:] = contexts[1:] != contexts[:-1]
        begins = np.flatnonzero(new)
        classes = (keys & np.uint64(CLASSES - 1)).astype(np.int64)
        return cls(contexts[begins], begins, np.cumsum(new) - 1, classes, counts)

    def batches(self, size: int) -> Iterator[tuple[slice, slice]]:
        """Some contexts at a time, with their entries."""
        ends = np.append(self.begins, len(self.of))
        for first in range(0, len(self.contexts), size):
            last = min(first + size, len(self.contexts))
            yield slice(first, last), slice(int(ends[first]), int(ends[last]))


def trained_on(model: Model, seen: Contexts) -> tuple[np.ndarray, np.ndarray]:
    """Gradient steps of one learner over its contexts: the change of the weights, and how often each feature occurred."""
    weights, squares = model.weights.copy(), np.full_like(model.weights, 1e-2)
    times = np.zeros(len(weights))
    whole = np.bincount(seen.of, seen.counts, len(seen.contexts))
    size = min(max(len(seen.contexts) // 64, 512), BATCH)
    for some, entries in seen.batches(size):
        rows = _rows(seen.contexts[some])
        miss = replace(model, weights=weights).class_chances(rows)
        miss *= whole[some, None]
        miss[seen.of[entries] - some.start, seen.classes[entries]] -= seen.counts[entries]
        for row in rows:
            order = np.argsort(row.astype(np.uint16), kind="stable")  # sorted by digits
            ordered = row[order]
            begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            used, slope = ordered[begins], np.add.reduceat(miss[order], begins, axis=0)
            times[used] += np.add.reduceat(whole[some][order], begins)
            squares[used] += slope * slope
            weights[used] -= RATE * slope / np.sqrt(squares[used])
    return weights - model.weights, times


def _trained(shared: DataFrame, model: Model, slices: int) -> Model:
    """One round: the model with the changes of all slices averaged."""
    held = shared.sparkSession.sparkContext.broadcast(model)
    features, classes = model.weights.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, keys, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                keys, counts = ascended(keys), widened(counts)
                change, times = trained_on(held.value, Contexts.from_keys(keys[counts > 0], counts[counts > 0]))
                yield _sent(np.concatenate([(change * times[:, None]).ravel(), times]), _PARTS, number)

    total = features * classes + features
    sums = _added(shared.select("slice", "keys", "counts").mapInArrow(run, _SENT), total // _PARTS, slices)
    if not len(sums):
        return model
    change, times = np.split(sums, [features * classes])
    weights = model.weights + change.reshape(features, classes) / np.maximum(times.reshape(-1, 1), 1)
    return replace(model, weights=weights.astype(np.float32))


def log_chances(model: Model, seen: Contexts) -> np.ndarray:
    """log10 of the chance of each entry's class: the table's odds, times what the pair's own weights add.

    A pair has a weight for each class that training texts have behind it. They are found by steps along the gradient, scaled by
    the curvature, from the counts of the pair and the chances by the table; PRIOR holds them towards nothing.
    """
    result = np.zeros(len(seen.of))
    for some, entries in seen.batches(BATCH):
        of = seen.of[entries] - some.start
        chance = np.maximum(model.class_chances(_rows(seen.contexts[some]))[of, seen.classes[entries]].astype(np.float64), 1e-14)
        n = seen.counts[entries].astype(np.float64)
        contexts, known = some.stop - some.start, n > 0
        whole = np.bincount(of, n, contexts)[of]
        other = np.maximum(1 - np.bincount(of, chance * known, contexts), 0)
        # they begin where the classes seen have the shares of their counts and one more count is left to all others
        weight = np.where(known, np.clip(np.log(np.maximum(n, 1) * np.maximum(other, 1e-14)[of] / chance), -20, 20), 0)
        for _ in range(STEPS):
            odds = np.where(known, chance * np.exp(weight), 0)
            expected = whole * odds / np.maximum(other + np.bincount(of, odds, contexts), 1e-14)[of]
            weight += np.where(known, (n - expected - PRIOR * weight) / (np.maximum(n, expected) + PRIOR), 0)
        odds = chance * np.exp(weight)
        norm = other + np.bincount(of, odds * known, contexts)
        result[entries] = np.log10(odds) - np.log10(np.maximum(norm, 1e-14))[of]
    return np.minimum(result, 0)


def _answered(shared: DataFrame, model: Model) -> DataFrame:
    """(slice, chunks, answers): the log-chances of what each chunk sent."""
    held = shared.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                number, keys, counts, chunks, places = (batch.column(i)[row].as_py() for i in range(5))
                logs = log_chances(held.value, Contexts.from_keys(ascended(keys), widened(counts)))
                steps = np.minimum(np.rint(-logs * FRACTION), (1 << 16) - 1).astype("<u2")
                answers = [packed(steps[ascended(p).astype(np.int64)]) for p in places]
                columns = [pa.array([number], pa.int64()), pa.array([chunks], pa.list_(pa.int64())), pa.array([answers], pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["slice", "chunks", "answers"])

    rows = shared.select("slice", "keys", "counts", "chunks", "places")
    return rows.mapInArrow(run, "slice bigint, chunks array<bigint>, answers array<binary>")


# --- fitting and scoring --------------------------------------------------------------------------


def _mass(totals: DataFrame, scale: float, slices: int) -> np.ndarray:
    """Probability of each bucket by smoothed counts; each bucket has its unknown words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, words, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                counts = widened(counts)
                known = np.where(counts > 0, (counts + ALPHA) / scale, 0)
                yield _sent(np.bincount(_buckets(ascended(words)), known, BUCKETS), 1, number)

    mass = _added(totals.select("slice", "words", "totals").mapInArrow(run, _SENT), BUCKETS, slices).astype(np.float64)
    return (mass if len(mass) else np.zeros(BUCKETS)) + ALPHA / scale


def fit(chunks: DataFrame, mass: np.ndarray, plan: Plan, tasks: int) -> tuple[Model, DataFrame]:
    """The model with its tables trained on all training texts of ``chunks``, and the contexts that have the pairs' counts."""
    markers = np.argsort(-mass, kind="stable")[:MARKERS]
    classes = _classes(mass, _company(chunks, markers, tasks))
    share = np.bincount(classes, mass, CLASSES)
    bias = np.log(np.maximum(share, 1e-9)).astype(np.float32)
    within = _within(_followers(chunks, classes, tasks), mass, classes)
    model = Model(classes, np.zeros((sum(FEATURES), CLASSES), np.float32), bias, within, mass)
    shared = staged(shared_contexts(chunks, classes, plan), "shared-contexts")
    for _ in range(ROUNDS):
        model = _trained(shared, model, 1 << plan.slice_bits)
    return model, shared


def _scored(asked: DataFrame, model: Model, plan: Plan, scale: float, schema: str) -> DataFrame:
    """Per document its tokens, how many are known, and the sums of both logarithms."""
    held = asked.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        mass = np.log10(model.mass)
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = Chunk.of(*(batch.column(c)[row].as_py() for c in _LOADED))
                totals, answers = (batch.column(c)[row].as_py() for c in ("totals", "chances"))
                counts = np.concatenate([widened(t) for t in totals])  # slices are ranges, and words in order
                base = np.log10((counts + ALPHA) / scale)[chunk.ids]
                keys = chunk.keys(model.classes, plan.pair_bits)
                order = np.argsort(keys)
                ordered = keys[order]
                at = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))
                steps = np.concatenate([unpacked(a, "<u2") for a in answers])
                gain = np.empty(len(keys))
                gain[order] = steps[at] / -FRACTION
                here, before = _buckets(chunk.here), model.classes[_buckets(chunk.before)]
                gain += model.within[before, here] - mass[here]
                of, n = np.repeat(np.arange(len(chunk.lengths)), chunk.lengths), len(chunk.lengths)
                known = np.bincount(of, (counts > 0)[chunk.ids], n).astype(np.int64)
                base, gain = np.bincount(of, base, n), np.bincount(of, gain, n)
                result = [*chunk.docs.combine_chunks().to_batches()[0].columns, *map(pa.array, (known, base, np.minimum(base + gain, 0)))]
                yield pa.RecordBatch.from_arrays(result, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return asked.select(*_LOADED, "totals", "chances").mapInArrow(run, schema)


def text_scores(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32 of doc_id as text (a null as empty) is not divisible by 10. base_score is the log10
    probability under smoothed token counts, score that of the model, whose chances of classes are rounded to steps of
    2^-12 in the logarithm. Scores do not depend on how the rows are partitioned or ordered, but for the rounding of sums. A null
    text counts as empty: its end alone. Repeated rows are learned from and scored each. Without training rows all
    tokens are unknown. An empty table gives no rows.

    Texts are read once. What chunks and slices send each other is a few bytes for each different (pair, class) of a
    chunk. At 100 TB set ``chunk_bytes`` to some 256 MB; slices grow with the root of the corpus by themselves.
    """
    rows = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), full_text().alias("text"))
    chunks = staged(chunked(rows, chunk_bytes), "token-chunks")
    number, tokens, kinds = chunks.agg(F.count(F.lit(1)), F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    word_bits = max(2, math.ceil(math.log2(max(kinds, 1) / SLICE_WORDS)))
    totals = staged(token_totals(chunks, word_bits), "token-totals")
    train_tokens, known = _training_counts(totals)
    scale, plan = train_tokens + ALPHA * (known + 1), Plan.of(tokens)
    model, shared = fit(chunks, _mass(totals, scale, 1 << word_bits), plan, number)
    asked = chunks.join(_by_chunk(totals, "totals"), "chunk").join(_by_chunk(_answered(shared, model), "chances"), "chunk")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = _scored(asked, model, plan, scale, schema)
    train = F.lit(int(train_tokens)).cast("bigint").alias("train_tokens")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", train, "base_score", "score")


def _training_counts(totals: DataFrame) -> tuple[int, int]:
    """Tokens of the training texts, and how many different ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [widened(c) for c in batch.column(0).to_pylist()]
            sums = [pa.array([int(c.sum()) for c in counts], pa.int64()), pa.array([int((c > 0).sum()) for c in counts], pa.int64())]
            yield pa.RecordBatch.from_arrays(sums, names=["n", "kinds"])

    found = totals.select("totals").mapInArrow(run, "n bigint, kinds bigint")
    return tuple(found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first())
