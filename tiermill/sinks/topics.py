"""Topic writes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tiermill.operators.messages import encode
from tiermill.sinks.files import BatchSink
from tiermill.sources.topics import TopicConnection


def write_topic(messages: DataFrame, connection: TopicConnection, topic: str) -> None:
    """Send (key, value) rows to a topic. Every run sends all rows again."""
    messages.write.format("kafka").options(**connection.options()).option("topic", topic).save()


def topic_sink(connection: TopicConnection, topic: str, key: str) -> BatchSink:
    """Micro-batch sink: each row as a (key, JSON value) message."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_topic(encode(batch, key), connection, topic)

    return write
