"""Shards and slots of every row against a plain walk of the permutation."""

import math
import os
import struct
import zlib

import pyarrow.parquet as pq
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tiermill.llm import sharding

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def hashed(*values):
    """Spark's xxhash64 of integers given as (value, format); nulls leave it as it is."""
    seed = 42
    for value, kind in values:
        if value is not None:
            seed = xxhash.xxh64_intdigest(struct.pack(kind, value), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def permuted(number, total, seed=0):
    left_size = math.isqrt(total - 1) + 1 if total > 1 else 1
    right_size = -(-total // left_size)

    def once(x):
        left, right = divmod(x, right_size)
        for turn in range(sharding.ROUNDS):
            if turn % 2 == 0:
                left = (left + hashed((right, "<q"), (seed, "<i"), (turn, "<i")) % left_size) % left_size
            else:
                right = (right + hashed((left, "<q"), (seed, "<i"), (turn, "<i")) % right_size) % right_size
        return left * right_size + right

    at = once(number)
    while at >= total:
        at = once(at)
    return at


def plain_shards(rows, shards, seed=0, buckets=4096):
    """Sorted (row, shard, slot): numbered by hashed bucket, then by value, nulls first."""
    order = sorted(rows, key=lambda r: (hashed(*((v, "<q") for v in r)) % buckets, [(v is not None, v) for v in r]))
    places = ((row, permuted(n, len(rows), seed)) for n, row in enumerate(order))
    return sorted(((row, at % shards, at // shards) for row, at in places), key=repr)


def test_the_query_equals_a_plain_walk(spark):
    documents = pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()
    rows = []
    for d in documents:
        data = (d["text"] or "").encode()
        rows.append((d["doc_id"], len(data) + 16, zlib.crc32(data)))
    found = registry.queries()["op1_sharding"](spark, SF_DIR).collect()
    assert sorted((((r.doc_id, r.size, r.text_crc32), r.shard, r.slot) for r in found), key=repr) == plain_shards(rows, 40)


def test_odd_rows_equal_a_plain_walk(spark, odd_documents, odd_rows):
    narrow = odd_documents.select("doc_id", F.crc32(F.coalesce("text", F.lit(""))).alias("crc"))
    rows = [(i, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows]
    found = sharding.shard_rows(narrow, 7, seed=3, keys=["doc_id"]).collect()
    assert sorted((((r.doc_id, r.crc), r.shard, r.slot) for r in found), key=repr) == plain_shards(rows, 7, seed=3)
