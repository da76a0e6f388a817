"""Starting streaming queries and delivering micro-batches to several sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tiermill.sinks.files import BatchSink
from tiermill.sources.layers import found_parquet

# Records kept per sink. Writing one replaces the oldest, so the newest is whole at all times.
_SLOTS = 2
_PARTITIONS = "spark.sql.shuffle.partitions"


class SinkLedger:
    """Which micro-batch each sink finished last, in a folder beside the checkpoint.

    A record is written when the sink returns. If the stream dies between the two, that one sink sees the batch again;
    sinks that had their record do not.
    """

    def __init__(self, path: str) -> None:
        self.path = path

    def finished(self, spark: SparkSession, sink: str) -> int:
        """The last micro-batch that ``sink`` finished, or -1."""
        records = found_parquet(spark, f"{self.path}/{sink}", "batch_id bigint, slot int")
        last = None if records is None else records.agg(F.max("batch_id")).first()[0]
        return -1 if last is None else last

    def record(self, spark: SparkSession, sink: str, batch_id: int) -> None:
        row = spark.createDataFrame([(batch_id,)], "batch_id bigint").coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.path}/{sink}/slot={batch_id % _SLOTS}")


def named_sinks(sinks: Sequence[BatchSink] | Mapping[str, BatchSink]) -> dict[str, BatchSink]:
    """Sinks under their names, or under their places."""
    return dict(sinks) if isinstance(sinks, Mapping) else {f"sink-{n}": sink for n, sink in enumerate(sinks)}


def fan_out(*sinks: BatchSink, ledger: SinkLedger | None = None, **named: BatchSink) -> BatchSink:
    """Hand each micro-batch to every sink in turn, computing it once.

    The sinks cannot commit together: if one fails, the batch is run again and the sinks before it see it
    a second time, under the same ``batch_id``. With a ``ledger`` they do not: what a sink has finished is skipped. A batch that
    all have finished is computed all the same, because that is what brings the stream's state up to it. The ledger knows sinks by
    name, or by place if they are given without; keep these over a restart. A batch can only come again as the first one of
    a run, so that is when the ledger is read.
    """
    targets = named_sinks(sinks) | named
    finished: dict[str, int] = {}

    def deliver(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if ledger is not None and not finished:
            finished.update({name: ledger.finished(spark, name) for name in targets})
        left = {name: sink for name, sink in targets.items() if finished.get(name, -1) < batch_id}
        if not left:
            batch.write.format("noop").mode("overwrite").save()
            return
        held = batch.persist()
        try:
            for name, sink in left.items():
                sink(held, batch_id)
                if ledger is not None:
                    ledger.record(spark, name, batch_id)
                    finished[name] = batch_id
        finally:
            held.unpersist()

    return deliver


def start(
    stream: DataFrame, writer: DataStreamWriter, checkpoint: str | None, available_now: bool, partitions: int | None = None
) -> StreamingQuery:
    """Start the query that writes ``stream``.

    ``checkpoint`` lets a restart go on where the query stopped; ``available_now`` stops it at the end of the input. A query takes
    the session's options as they are when it starts; with ``partitions`` it has that many shuffle partitions, the session as before.
    """
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    if partitions is None:
        return writer.start()
    conf = stream.sparkSession.conf
    before = conf.get(_PARTITIONS)
    conf.set(_PARTITIONS, str(partitions))
    try:
        return writer.start()
    finally:
        conf.set(_PARTITIONS, before)
