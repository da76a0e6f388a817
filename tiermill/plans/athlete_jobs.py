"""The athlete jobs, bound to their tables and topics."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tiermill.operators.averages import RunTime
from tiermill.plans import athletes as names
from tiermill.plans.tables import publish_changes, publish_table, valid_dimension
from tiermill.sinks.jdbc import table_sink
from tiermill.sinks.topics import topic_sink, write_topic
from tiermill.sources.jdbc import JdbcConnection, KeyRange, read_table
from tiermill.sources.topics import TopicConnection, read_topic
from tiermill.streaming.following import FollowingQuery, Generation, HeldDimension, KeySketch
from tiermill.streaming.pipelines import COPIES, PRINTED, average_messages, hold_dimension, start_updates, tail

# How a table is read: by key ranges or conditions, one task each. None reads it in one task and must be said.
Split = KeyRange | Sequence[str] | None
# Partitions of the bios held on the executors.
HELD_PARTITIONS = 200


def publish_results(
    spark: SparkSession, database: JdbcConnection, broker: TopicConnection, split: Split, state: str | None = None
) -> None:
    """Send the results table to the results topic, keyed by athlete.

    Every row on every run, or, with a folder ``state`` that remembers the last publication, what is new or changed since.
    """
    results = read_table(spark, database, names.RESULTS, split)
    if state is None:
        publish_table(results, names.KEY, broker, names.RESULTS)
    else:
        publish_changes(results, names.KEY, lambda m: write_topic(m, broker, names.RESULTS), state)


def athlete_bios(spark: SparkSession, database: JdbcConnection, split: Split) -> DataFrame:
    """The bio rows whose height and weight are numbers."""
    return valid_dimension(read_table(spark, database, names.BIO, split), names.KEY, names.MEASURES)


def result_averages(
    messages: DataFrame,
    bios: DataFrame,
    hot: Sequence[str] = (),
    copies: int = COPIES,
    exact_scale: int | None = None,
    run_ts: RunTime = None,
    watch: Callable[[DataFrame], DataFrame] = lambda facts: facts,
) -> DataFrame:
    """Average height and weight per sport, medal, sex and country over a stream of result messages."""
    averages = average_messages(
        messages,
        names.RESULT_SCHEMA,
        bios,
        (names.KEY, names.KEY),
        names.FACT_KEYS,
        names.DIMENSION_KEYS,
        dimension_measures=names.MEASURES,
        exact_scale=exact_scale,
        run_ts=run_ts,
        hot=hot,
        copies=copies,
        watch=watch,
    )
    return averages.select(*names.OUTPUT_COLUMNS)


def stream_results(
    spark: SparkSession,
    database: JdbcConnection,
    broker: TopicConnection,
    checkpoint: str | None,
    split: Split,
    max_per_batch: int | None = None,
    hold: int | None = HELD_PARTITIONS,
    hot: Sequence[str] = (),
    batch_column: str | None = None,
) -> StreamingQuery:
    """Run the averages on the results topic; each update goes to the output topic and the output table.

    The bios are held on the executors in ``hold`` partitions, so the database is read once and not for every
    micro-batch; athletes in ``hot`` are divided over several tasks. With ``hold=None`` the bios are read anew, and later changes
    of the table seen, in every batch. ``checkpoint`` and ``split`` must be stated; a checkpoint of None is for trials.
    """
    needed = [names.KEY, *names.DIMENSION_KEYS, *names.MEASURES]
    bios = athlete_bios(spark, database, split).select(*needed)
    if hold is not None:
        bios = hold_dimension(bios, names.KEY, hold, hot)
    messages = read_topic(spark, broker, names.RESULTS, max_per_batch=max_per_batch)
    averages = result_averages(messages, bios, hot)
    sinks = [
        topic_sink(broker, names.OUTPUT, names.OUTPUT_KEY),
        table_sink(database, names.OUTPUT, batch_column),
    ]
    return start_updates(averages, sinks, checkpoint)


def follow_results(
    spark: SparkSession,
    database: JdbcConnection,
    broker: TopicConnection,
    checkpoint: str,
    split: Split,
    max_per_batch: int | None = None,
    hold: int = HELD_PARTITIONS,
    share: float = 0.02,
    version: str | None = None,
    batch_column: str | None = None,
    available_now: bool = False,
) -> FollowingQuery:
    """``stream_results`` that finds its hot athletes itself, sees changes of the bios, and keeps a ledger of its sinks.

    Athletes with more than ``share`` of the latest messages are divided over several tasks from the next micro-batch on.
    ``version`` is a table or subquery of one row that differs whenever the bios have changed, such as ``(SELECT
    MAX(changed_at) AS v FROM athlete_bio) AS v``; it is asked before each micro-batch, and where it differs the bios are
    read again. Wait for the result with ``awaitTermination``, which also starts the query again after such a change.
    """
    needed = [names.KEY, *names.DIMENSION_KEYS, *names.MEASURES]

    def present() -> Hashable:
        return None if version is None else tuple(map(str, read_table(spark, database, version, None).first()))

    bios = HeldDimension(lambda: athlete_bios(spark, database, split).select(*needed), names.KEY, hold, present)
    sketch = KeySketch(names.KEY, share)

    def averages(generation: Generation) -> DataFrame:
        messages = read_topic(spark, broker, names.RESULTS, max_per_batch=max_per_batch)
        return result_averages(messages, bios.generation(*generation), generation.hot, watch=sketch.watched)

    sinks = {
        "topic": topic_sink(broker, names.OUTPUT, names.OUTPUT_KEY),
        "table": table_sink(database, names.OUTPUT, batch_column),
    }
    return FollowingQuery(spark, averages, sinks, checkpoint, present, sketch, available_now, ledger=True)


def tail_output(spark: SparkSession, broker: TopicConnection, max_per_batch: int = PRINTED) -> StreamingQuery:
    """Print what arrives in the output topic, a bounded number of messages at a time."""
    return tail(read_topic(spark, broker, names.OUTPUT, max_per_batch=max_per_batch))
