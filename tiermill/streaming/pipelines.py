"""The two streams: enrich-and-average, and the topic tail."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tiermill.operators.averages import RunTime, enriched_averages
from tiermill.operators.joins import SALT, Columns, named, salted, spread
from tiermill.operators.messages import decode, value_text
from tiermill.sinks.files import BatchSink
from tiermill.streaming.delivery import SinkLedger, fan_out, named_sinks, start

# Copies of the dimension rows of a hot key.
COPIES = 8
# Messages printed of a micro-batch, and the bound on a micro-batch of the tail job.
PRINTED = 1_000


def average_messages(
    messages: DataFrame,
    schema: T.StructType,
    dimension: DataFrame,
    on: tuple[str, str],
    fact_keys: Columns,
    dimension_keys: Columns,
    fact_measures: Columns = (),
    dimension_measures: Columns = (),
    digits: int = 2,
    exact_scale: int | None = None,
    stamp: str | None = "timestamp",
    run_ts: RunTime = None,
    hot: Sequence[str] = (),
    copies: int = COPIES,
    watch: Callable[[DataFrame], DataFrame] = lambda facts: facts,
) -> DataFrame:
    """Running averages over JSON messages joined to a static dimension table.

    Only the message fields in use are parsed. Messages that do not parse, or whose key the dimension lacks,
    are dropped by the join; a measure that is no number counts as null. The groups are the state; it has no expiry, so it
    grows with the number of groups and not with the number of messages.

    Streams have no adaptive execution to split a key that fills much of a micro-batch. For keys listed in ``hot``
    (``hot_keys`` finds them) the dimension's rows are copied ``copies`` times and the messages take turns; all other rows
    are there once. A dimension from ``hold_dimension`` must have been held with the same two values. ``watch`` is put
    between decoding and the join; ``KeySketch.watched`` there finds the hot keys while the stream runs.
    """
    if SALT not in dimension.columns:
        needed = sorted({on[1], *named(dimension_keys).values(), *named(dimension_measures).values()})
        dimension = dimension.select(*needed)
        if hot:
            dimension = spread(dimension, on[1], hot, copies)
    used = {on[0], *named(fact_keys).values(), *named(fact_measures).values()}
    facts = watch(decode(messages, schema, [name for name in schema.names if name in used]))
    if SALT in dimension.columns:
        facts = facts.withColumn(SALT, salted(F.col(f"`{on[0]}`"), hot, copies))
    return enriched_averages(
        facts,
        dimension,
        on,
        fact_keys,
        dimension_keys,
        fact_measures,
        dimension_measures,
        key_type="string",
        digits=digits,
        exact_scale=exact_scale,
        stamp=stamp,
        run_ts=run_ts,
    )


def hold_dimension(
    dimension: DataFrame, key: str, partitions: int, hot: Sequence[str] = (), copies: int = COPIES
) -> DataFrame:
    """Keep a large dimension on the executors, for all micro-batches: partitioned and sorted by its key.

    Otherwise it is read, shuffled and sorted again for every micro-batch. ``key`` must already be text. Pass the same
    ``hot`` and ``copies`` to ``average_messages``. What is held does not see later changes of the table; it is spilled
    to disk, and rebuilt where an executor is lost.
    """
    keys = [key, SALT]
    return spread(dimension, key, hot, copies).repartition(partitions, *keys).sortWithinPartitions(*keys).persist()


def start_updates(
    averages: DataFrame,
    sinks: Sequence[BatchSink] | Mapping[str, BatchSink],
    checkpoint: str | None,
    available_now: bool = False,
    ledger: bool = False,
    partitions: int | None = None,
) -> StreamingQuery:
    """Write, per micro-batch, the groups that received rows to every sink.

    ``checkpoint`` is the shared folder for positions and state. None is for trials alone: both then lie in a temporary
    folder, and a restart begins anew. ``ledger`` records beside the checkpoint which sink has finished which batch, so that a
    batch that is run again goes only to the others; for sinks that append, and not for those that replace what they wrote.
    ``partitions`` divides the state, from the first start on, into so many parts in place of ``spark.sql.shuffle.partitions``. Each
    micro-batch commits every part and writes a file of it to every sink, so a state of few groups should have few.
    """
    if ledger and checkpoint is None:
        raise ValueError("a ledger of the sinks needs a checkpoint")
    records = SinkLedger(f"{checkpoint}/sinks") if ledger else None
    writer = averages.writeStream.foreachBatch(fan_out(ledger=records, **named_sinks(sinks))).outputMode("update")
    return start(averages, writer, checkpoint, available_now, partitions)


def print_messages(rows: int = PRINTED) -> BatchSink:
    """Micro-batch sink: print up to ``rows`` messages and say how many more there were."""

    def write(batch: DataFrame, batch_id: int) -> None:
        shown = [row["value"] for row in batch.limit(rows).collect()]
        print(f"batch {batch_id}", *shown, sep="\n")
        if len(shown) == rows and (more := batch.count() - rows):
            print(f"and {more} more")

    return write


def tail(messages: DataFrame, available_now: bool = False, rows: int = PRINTED) -> StreamingQuery:
    """Print the text of each new message; of a micro-batch of more than ``rows``, so many and how many are left out."""
    writer = value_text(messages).writeStream.outputMode("append").foreachBatch(fan_out(print_messages(rows)))
    return start(messages, writer, None, available_now)


def tail_to_files(
    messages: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append the text of each new message to parquet files."""
    writer = value_text(messages).writeStream.outputMode("append").format("parquet").option("path", path)
    return start(messages, writer, checkpoint, available_now)
