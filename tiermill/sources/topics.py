"""Message topics: connection options, the topic stream, and a folder of messages read as a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Topic security and start position used when none are given.
SECURITY_PROTOCOL = "SASL_PLAINTEXT"
SASL_MECHANISM = "PLAIN"
START = "earliest"

MESSAGE_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType(), True), T.StructField("value", T.BinaryType(), True)]
)


@dataclass(frozen=True)
class TopicConnection:
    """Brokers and login. Without a user name the connection is left unsecured."""

    servers: str
    user: str | None = None
    password: str | None = None
    protocol: str = SECURITY_PROTOCOL
    mechanism: str = SASL_MECHANISM

    def __repr__(self) -> str:
        return f"TopicConnection(servers={self.servers!r}, user={self.user!r}, protocol={self.protocol!r})"

    def options(self) -> dict[str, str]:
        """Options that reader and writer share."""
        shared = {"kafka.bootstrap.servers": self.servers}
        if self.user is not None:
            shared["kafka.security.protocol"] = self.protocol
            shared["kafka.sasl.mechanism"] = self.mechanism
            shared["kafka.sasl.jaas.config"] = _login(self.user, self.password or "")
        return shared


def _login(user: str, password: str) -> str:
    def quoted(text: str) -> str:
        return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'

    module = "org.apache.kafka.common.security.plain.PlainLoginModule"
    return f"{module} required username={quoted(user)} password={quoted(password)};"


def read_topic(
    spark: SparkSession,
    connection: TopicConnection,
    topic: str,
    start: str = START,
    max_per_batch: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """A topic as a stream of (key, value, ...) rows.

    ``max_per_batch`` caps the messages of one micro-batch. ``min_partitions`` lets more tasks read than the
    topic has partitions, which also splits a partition that holds most of the messages.
    """
    reader = spark.readStream.format("kafka").options(**connection.options())
    reader = reader.option("subscribe", topic).option("startingOffsets", start)
    if max_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_per_batch))
    if min_partitions is not None:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load()


def read_message_folder(spark: SparkSession, path: str, max_files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of (key, value) rows as a stream, from the first file on."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA).format("parquet")
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    return reader.load(path)
