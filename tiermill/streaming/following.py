"""Streams whose plan follows the data: hot keys found in the micro-batches, and a held dimension that changes.

A streaming plan is fixed when the query starts. What it was built with is compared before each micro-batch with what holds now;
if they differ, the batch is put off, the query starts again from its checkpoint with a new plan, and the same batch is its first.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Callable, Hashable, Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

from tiermill.sinks.files import BatchSink
from tiermill.streaming.delivery import SinkLedger, fan_out, named_sinks, start
from tiermill.streaming.pipelines import COPIES, hold_dimension

_SKETCH = "sketch struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>"


class KeySketch:
    """The keys that hold more than ``share`` of the messages of the last ``batches`` micro-batches.

    Each micro-batch is sketched while it runs (Spark's approximate top-k, merged over tasks), so no table is grouped and no
    job is added to it. The sketches of the last micro-batches are combined; each is bounded by ``tracked`` keys.
    """

    NAME = "tiermill_keys"

    def __init__(self, key: str, share: float = 0.02, batches: int = 8, tracked: int = 10_000) -> None:
        if not 0 < share < 1:
            raise ValueError("share must lie between 0 and 1")
        self.key, self.share, self.tracked = key, share, tracked
        self.window: deque[tuple[tuple[object, ...], int]] = deque(maxlen=batches)
        self.learned: tuple[str, int] | None = None
        self.keys: tuple[str, ...] = ()

    def watched(self, facts: DataFrame) -> DataFrame:
        """``facts``, a stream, with the sketch of each micro-batch among its metrics."""
        key = f"CAST(`{self.key}` AS STRING)"
        sketch = F.expr(f"approx_top_k_accumulate({key}, {self.tracked})").alias("sketch")
        return facts.observe(self.NAME, sketch, F.count(F.expr(key)).alias("messages"))

    def learn(self, spark: SparkSession, progress: StreamingQueryProgress | None) -> tuple[str, ...]:
        """Take in the metrics of a finished micro-batch, once, and return the hot keys, fewer than 1 / share."""
        metrics = progress.observedMetrics.get(self.NAME) if progress is not None else None
        if metrics is None or self.learned == (progress.runId, progress.batchId) or not metrics["messages"]:
            return self.keys
        self.learned = (progress.runId, progress.batchId)
        sketch = dict(metrics["sketch"])
        row = (base64.b64decode(sketch["sketch"]), sketch["maxItemsTracked"], None, sketch["itemDataTypeDDL"])
        self.window.append((row, metrics["messages"]))
        most, messages = int(1 / self.share) + 1, sum(n for _, n in self.window)
        sketches = spark.createDataFrame([(row,) for row, _ in self.window], _SKETCH).coalesce(1)
        top = sketches.select(F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {self.tracked}), {most})")).first()[0]
        self.keys = tuple(sorted(r["item"] for r in top if r["item"] is not None and r["count"] > self.share * messages))
        return self.keys


class HeldDimension:
    """A dimension kept on the executors, one generation after the other.

    ``load`` reads the table as it is now, its key as text; ``version`` tells, cheaply, when it has changed: a number that the
    table's owner counts up, a latest time of change, or ``files_version`` of its folder.
    """

    def __init__(
        self, load: Callable[[], DataFrame], key: str, partitions: int, version: Callable[[], Hashable], copies: int = COPIES
    ) -> None:
        self.load, self.key, self.partitions, self.version, self.copies = load, key, partitions, version, copies
        self.held: DataFrame | None = None
        self.of: tuple[Hashable, Sequence[str]] | None = None

    def generation(self, version: Hashable, hot: Sequence[str]) -> DataFrame:
        """The dimension held for this version and these hot keys; what was held before is let go."""
        if self.of != (version, hot):
            self.release()
            self.held = hold_dimension(self.load(), self.key, self.partitions, hot, self.copies)
            self.of = (version, hot)
        return self.held

    def release(self) -> None:
        """Let go of what is held."""
        if self.held is not None:
            self.held.unpersist()
        self.held = self.of = None


def files_version(spark: SparkSession, path: str) -> tuple[int, str]:
    """What changes whenever files are added to a folder, replaced or removed; reads their names, times and sizes alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    row = files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("sum"),
    ).first()
    return row["files"], row["sum"]


class PutOff(Exception):
    """Ends a query whose plan is out of date; Spark logs it as the failure of a micro-batch, which is then run again."""


class Generation(NamedTuple):
    """What a plan depends on: the version of the dimension and the hot keys."""

    version: Hashable
    hot: tuple[str, ...]


class FollowingQuery:
    """A streaming query that is started anew, from its checkpoint, whenever its plan is out of date.

    ``build`` makes the averages for a generation. ``awaitTermination`` is what starts the query again, so something must wait for it.
    A batch is put off at most once. After a restart of the process the sketch begins anew: hot keys are known after a batch.
    ``partitions`` is as for ``start_updates``.
    """

    def __init__(
        self,
        spark: SparkSession,
        build: Callable[[Generation], DataFrame],
        sinks: Sequence[BatchSink] | Mapping[str, BatchSink],
        checkpoint: str,
        version: Callable[[], Hashable] = lambda: None,
        sketch: KeySketch | None = None,
        available_now: bool = False,
        ledger: bool = False,
        partitions: int | None = None,
    ) -> None:
        self.spark, self.build, self.sinks, self.checkpoint = spark, build, sinks, checkpoint
        self.version, self.sketch, self.available_now, self.ledger = version, sketch, available_now, ledger
        self.partitions = partitions
        self.generations: list[Generation] = []
        self.query: StreamingQuery | None = None
        self._put_off: int | None = None
        self._outdated = False
        self._begin(self._present())

    def _present(self) -> Generation:
        progress = self.query.lastProgress if self.query is not None else None
        return Generation(self.version(), self.sketch.learn(self.spark, progress) if self.sketch is not None else ())

    def _begin(self, generation: Generation) -> None:
        self.generations.append(generation)
        self.query, self._outdated = None, False
        ledger = SinkLedger(f"{self.checkpoint}/sinks") if self.ledger else None
        deliver = fan_out(ledger=ledger, **named_sinks(self.sinks))

        def unless_outdated(batch: DataFrame, batch_id: int) -> None:
            if batch_id != self._put_off:
                present = self._present()
                if present != generation:
                    self._put_off, self._outdated = batch_id, True
                    raise PutOff(f"batch {batch_id}: {generation} has become {present}")
            deliver(batch, batch_id)

        averages = self.build(generation)
        writer = averages.writeStream.foreachBatch(unless_outdated).outputMode("update")
        self.query = start(averages, writer, self.checkpoint, self.available_now, self.partitions)

    def awaitTermination(self, timeout: float | None = None) -> bool | None:
        """Wait until the query stops, starting it again where its plan is out of date; as the method of a streaming query.

        A ``timeout``, in seconds, counts from each new start.
        """
        while True:
            try:
                return self.query.awaitTermination(timeout)
            except StreamingQueryException:
                if not self._outdated:
                    raise
                self._begin(self._present())

    def stop(self) -> None:
        self.query.stop()
