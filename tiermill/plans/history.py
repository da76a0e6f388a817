"""Compaction of a stream's history: a snapshot of the newest rows, and the batches that came since.

An update-mode stream into an append-only table leaves one row per group and micro-batch. The snapshot holds the newest row of each
group, in buckets by key; a compaction merges the new batches into the buckets they touch and leaves the others where they lie. What
is current, folder by folder, is one record in the snapshot's log, so a compaction that fails changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.operators.averages import latest_per_key
from tiermill.sources.files import written
from tiermill.sources.layers import current_version, next_version, record_version

BUCKETS = 64
_BUCKET, _ORDER = "key_bucket", "batch_id"


@dataclass(frozen=True)
class Snapshot:
    """The current snapshot: all batches up to ``through`` are in it; ``folders`` has the folder of each bucket with rows."""

    through: int = -1
    buckets: int = BUCKETS
    folders: dict[str, str] = field(default_factory=dict)

    @classmethod
    def of(cls, spark: SparkSession, path: str) -> Snapshot | None:
        version = current_version(spark, path)
        return None if version is None else cls(**json.loads(version.note))

    def rows(self, spark: SparkSession, path: str, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The rows of these buckets, or of all."""
        wanted = self.folders if buckets is None else {str(b) for b in buckets} & self.folders.keys()
        paths = [f"{path}/{self.folders[b]}/{_BUCKET}={b}" for b in sorted(wanted)]
        return spark.read.parquet(*paths) if paths else None


def _batches(spark: SparkSession, history: str, after: int) -> DataFrame:
    rows = spark.read.parquet(history)
    return rows.withColumn(_ORDER, F.col(_ORDER).cast("bigint")).filter(F.col(_ORDER) > after)


def compact_history(
    spark: SparkSession, history: str, snapshot: str, keys: Sequence[str], buckets: int = BUCKETS, through: int | None = None
) -> Snapshot | None:
    """Merge the batches up to ``through`` that are not yet in the snapshot into it; returns the snapshot, or None if there is none.

    ``history`` is what ``parquet_sink`` wrote. Without ``through`` all batches but the newest are merged, which the stream may
    still be writing. A null key is a key. ``buckets`` is settled by the first compaction: each is merged by one task, so there should be as many as
    keep a bucket in a task's memory. Only touched buckets are read and written.
    """
    last = Snapshot.of(spark, snapshot) or Snapshot(buckets=buckets)
    new = _batches(spark, history, last.through)
    if through is None:
        newest = new.agg(F.max(_ORDER)).first()[0]  # from the folder names alone
        through = last.through if newest is None else newest - 1
    new = new.filter(F.col(_ORDER) <= through)
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(last.buckets)).cast("int")
    new = written(latest_per_key(new, keys).withColumn(_BUCKET, bucket), "new-batches")
    touched = [row[0] for row in new.select(_BUCKET).distinct().collect()]
    if not touched:
        return last if last.folders else None
    rows = new.drop(_BUCKET)
    before = last.rows(spark, snapshot, touched)
    if before is not None:
        rows = rows.unionByName(before)
    merged = latest_per_key(rows, keys).withColumn(_BUCKET, bucket)
    version = next_version(spark, snapshot)
    merged.repartition(len(touched), _BUCKET).write.partitionBy(_BUCKET).parquet(f"{snapshot}/{version.folder}")
    folders = last.folders | {str(b): version.folder for b in touched}
    now = Snapshot(through, last.buckets, folders)
    record_version(spark, snapshot, version, json.dumps(now.__dict__))
    return now


def latest_state(spark: SparkSession, history: str, snapshot: str, keys: Sequence[str]) -> DataFrame:
    """``latest_per_key`` over the whole history, read from the snapshot and the batches behind it."""
    last = Snapshot.of(spark, snapshot) or Snapshot()
    rows = _batches(spark, history, last.through)
    before = last.rows(spark, snapshot)
    return latest_per_key(rows if before is None else rows.unionByName(before), keys)
