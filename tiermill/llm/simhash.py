"""Near-duplicates by SimHash: fingerprints that differ in few bits, found by hashing balls around them.

Two fingerprints at distance 3 have a variant in common that is one flipped bit away from the one and two from the
other. So each fingerprint has a near ball (up to one flip) and a far shell (two flips), and who meets in a variant is
linked, provided one of them is there with its near ball: their distance is then 3 at most. Of three differing bits two lie
in the same half of the fingerprint, so the far shell needs only pairs of bits of the same half.

All variants of a fingerprint that begin with the same bits travel as one row to the bucket of that beginning and are
made on arrival. A bucket with many fingerprints is divided by eight more bits, as often as needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import extended, fitted, full_text, one_row_each, staged
from tiermill.llm.components import components, local_roots
from tiermill.llm.words import words_in_pieces

SHINGLE = 3
BITS = 3
SEED = 42
STEP = 8
HALF = 32
DEEPEST = 56
# Fingerprints in a bucket beyond which it is divided, and variants that a task holds at once.
FULL_BUCKET = 200_000
VARIANTS_AT_ONCE = 1 << 22
# Its odd multiples choose bits at random.
PARITY = 0x9E3779B97F4A7C15


# --- fingerprints ---------------------------------------------------------------------------------


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half of the hashes of the shingles; zero for a text without words."""
    ones, total, carried = np.zeros(64, np.int64), 0, []
    for words in words_in_pieces(text.encode().lower()):  # of bytes, lower() touches A-Z alone
        carried += words
        if len(carried) >= shingle:
            hashes = _hashes(carried, shingle)
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            total += len(hashes)
            carried = carried[len(carried) - shingle + 1 :]
    if not total and carried:
        hashes = _hashes(carried, len(carried))
        ones, total = np.unpackbits(hashes.view(np.uint8)).astype(np.int64), 1
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def _hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """Hash of each shingle, big-endian."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    return np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64).astype(">u8")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint of the whole text as a signed 64-bit integer."""
    narrow = docs.select(*[f"`{c}`" for c in keep], full_text().alias("__text"))
    schema = extended(narrow.drop("__text").schema, "fp bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(len(keep))], dtype=np.uint64)
            columns = [*batch.columns[:-1], pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "fp"])

    return narrow.mapInArrow(run, schema)


# --- buckets --------------------------------------------------------------------------------------


def _flips(bits: int, count: int) -> list[int]:
    """All patterns of up to ``count`` set bits among ``bits``."""
    return [sum(1 << i for i in chosen) for n in range(count + 1) for chosen in combinations(range(bits), n)]


def _deeper(rows: DataFrame, depth: int) -> DataFrame:
    """Rows (fp, prefix) of variants that begin with ``prefix`` (``depth`` bits), one per beginning of STEP bits more."""
    changed = F.col("prefix").bitwiseXOR(F.shiftrightunsigned("fp", 64 - depth)) if depth else F.lit(0).cast("bigint")
    flipped = F.bit_count(changed)
    if depth >= HALF:  # a second flip must be in the same half
        flipped = F.when(F.shiftrightunsigned(changed, depth - HALF) != 0, F.lit(2)).otherwise(flipped)
    patterns: Column = F.when(flipped == 0, F.array(*map(F.lit, _flips(STEP, 2))))
    patterns = patterns.when(flipped == 1, F.array(*map(F.lit, _flips(STEP, 1)))).otherwise(F.array(F.lit(0)))
    own = F.shiftrightunsigned("fp", 64 - depth - STEP).bitwiseAND(F.lit((1 << STEP) - 1).cast("bigint"))
    rows = rows.select("fp", "prefix", F.explode(patterns.cast("array<bigint>")).alias("pattern"))
    return rows.select("fp", F.shiftleft("prefix", STEP).bitwiseOR(own.bitwiseXOR(F.col("pattern"))).alias("prefix"))


def buckets(fps: DataFrame, full: int = FULL_BUCKET) -> DataFrame:
    """(fp, prefix, depth): in which buckets the variants of each distinct fingerprint lie."""
    count, depth = fps.count(), 0
    rows = fps.select("fp", F.lit(0).cast("bigint").alias("prefix"))
    while depth < STEP or (depth < HALF and count * len(_flips(depth, 2)) > full // 4 << depth):
        rows, depth = _deeper(rows, depth), depth + STEP
    ready = []
    while True:
        # at most (rows / full) buckets, however the fingerprints are distributed
        crowded = rows.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > full).select("prefix")
        crowded = staged(crowded, "crowded-buckets")
        if depth >= DEEPEST or crowded.isEmpty():  # the deepest buckets cannot hold many different fingerprints
            ready.append(rows.withColumn("depth", F.lit(depth)))
            break
        ready.append(rows.join(F.broadcast(crowded), "prefix", "left_anti").select("fp", "prefix", F.lit(depth).alias("depth")))
        rows = _deeper(rows.join(F.broadcast(crowded), "prefix", "left_semi").select("fp", "prefix"), depth)
        depth += STEP
    result = ready[0]
    for more in ready[1:]:
        result = result.unionByName(more)
    return result


# --- links within a bucket ------------------------------------------------------------------------


def _masks(depth: int, above: int, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Flips behind the first ``depth`` bits: those of the near ball, and of the far shell.

    Of the first bits ``above`` are flipped in the upper half and ``below`` in the lower.
    """
    upper = [1 << i for i in range(HALF, 64 - depth)]
    lower = [1 << i for i in range(min(HALF, 64 - depth))]
    if above + below == 0:
        near = [0, *upper, *lower]
        far = [x | y for half in (upper, lower) for x, y in combinations(half, 2)]
    elif above + below == 1:
        near, far = [0], upper if above else lower
    else:
        near, far = [], [0]
    return np.array(near, np.uint64), np.array(far, np.uint64)


def _dealt(numbers: np.ndarray, bits: int) -> list[np.ndarray]:
    """Places of the numbers in each of 2**bits parts. The part of x ^ y is that of x ^ that of y.

    Each bit of the part is the parity of half of the number's bits, so that numbers which differ in few bits are divided too.
    """
    part = np.zeros(len(numbers), np.int64)
    for i in range(bits):
        chosen = np.uint64(PARITY * (2 * i + 1) % (1 << 64))
        part |= (np.bitwise_count(numbers & chosen) & 1).astype(np.int64) << i
    order = np.argsort(part, kind="stable")
    return np.split(order, np.searchsorted(part[order], np.arange(1, 1 << bits)))


def bucket_links(fps: np.ndarray, prefix: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fp, fp) that join all fingerprints whose variants meet in the bucket, at most one per fingerprint."""
    changed = (fps >> np.uint64(64 - depth)) ^ np.uint64(prefix)
    above = np.bitwise_count(changed >> np.uint64(max(0, depth - HALF)))
    below = np.bitwise_count(changed) - above
    low = fps & np.uint64((1 << 64 - depth) - 1)  # the beginnings are equal in the bucket
    cases = [(0, 0), (1, 0), (2, 0), (0, 1), (0, 2)]
    kinds = [(np.flatnonzero((above == a) & (below == b)), *_masks(depth, a, b)) for a, b in cases]
    total = sum(len(own) * (len(near) + len(far)) for own, near, far in kinds)
    extra = max(0, int(np.ceil(np.log2(max(total, 1) / VARIANTS_AT_ONCE))))
    dealt = [(own, _dealt(low[own], extra)) for own, _, _ in kinds]
    sides = [[(masks, _dealt(masks, extra)) for masks in side] for side in ([k[1] for k in kinds], [k[2] for k in kinds])]
    root = np.arange(len(fps))
    for part in range(1 << extra):
        variants, owners, near_ones = [], [], 0
        for side in sides:
            for (own, own_parts), (masks, mask_parts) in zip(dealt, side):
                for begin, some in enumerate(mask_parts):
                    there = own[own_parts[part ^ begin]]
                    variants.append((low[there][:, None] ^ masks[some][None, :]).ravel())
                    owners.append(np.repeat(there, len(some)))
                    near_ones += len(variants[-1]) * (side is sides[0])
        variant, owner = np.concatenate(variants), np.concatenate(owners)
        del variants, owners
        order = np.argsort(variant, kind="stable")  # near ones of a variant stay before far ones
        variant = variant[order]
        first = np.flatnonzero(np.concatenate([[True], variant[1:] != variant[:-1]])) if len(variant) else order
        sizes = np.diff(np.append(first, len(variant)))
        met = (sizes > 1) & (order[first] < near_ones)
        hubs, sizes, first = owner[order[first[met]]], sizes[met], first[met]
        at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        a, b = np.repeat(hubs, sizes), owner[order[at]]
        true = (a != b) & (np.bitwise_count(fps[a] ^ fps[b]) <= BITS)
        root = local_roots(len(fps), root[a[true]], root[b[true]])[root]  # of a part's links only what they join is kept
    linked = np.flatnonzero(root != np.arange(len(fps)))
    return fps[linked], fps[root[linked]]


def links(fps: DataFrame, full: int = FULL_BUCKET) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints (column ``fp``) exactly as all pairs within three bits would."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        prefix, depth = int(key[0]), int(key[1])
        a, b = bucket_links(rows["fp"].to_numpy().view(np.uint64), prefix, depth)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return buckets(fps, full).groupBy("prefix", "depth").applyInPandas(run, "a bigint, b bigint")


# --- documents ------------------------------------------------------------------------------------


def near_copies(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = (), full: int = FULL_BUCKET) -> DataFrame:
    """Per row of ``docs``: doc_id, the columns ``keep``, fingerprint (16 hex digits), component_id, and ``root``.

    Fingerprints within three bits are linked; component_id is the smallest doc_id that links reach, null ids
    aside (null where there are no others). ``root`` is the same for a component's rows. Null and empty texts have
    fingerprint zero and are linked like any other. Repeated rows each give a row; an empty table gives none.
    """
    found = staged(fingerprints(docs, shingle, ("doc_id", *keep)), "fingerprints")
    count = found.count()
    distinct = staged(fitted(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), count), "distinct-fingerprints")
    rooted = distinct.join(components(links(distinct, full)).withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = staged(fitted(rooted, count), "rooted-fingerprints")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    places = staged(fitted(rooted.drop("first_id").join(smallest, "root"), count), "fingerprint-components")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.join(places, "fp").select("doc_id", *keep, digits, "component_id", "root")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id (null ids last, then by text digest)."""
    digested = docs.select("doc_id", "text", F.sha2(F.encode(full_text(), "UTF-8"), 256).alias("text_sha256"))
    near = near_copies(digested, shingle, ("text_sha256",))
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_sha256")
    kept = near.groupBy("root").agg(F.min(order).alias("kept")).select("kept.doc_id", "kept.text_sha256")
    return one_row_each(docs, kept)
