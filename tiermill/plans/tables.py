"""Jobs around a source table: publishing it as messages, and checking it as a dimension."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.operators.columns import cast_columns, keep_numeric
from tiermill.operators.messages import encode
from tiermill.sinks.topics import write_topic
from tiermill.sources.files import written
from tiermill.sources.layers import current_version, read_layer, replace_layer
from tiermill.sources.topics import TopicConnection


def publish_table(df: DataFrame, key: str, connection: TopicConnection, topic: str) -> None:
    """Send every row of a table to a topic as a JSON message."""
    write_topic(encode(df, key), connection, topic)


def publish_changes(
    df: DataFrame, key: str, send: Callable[[DataFrame], object], state: str, deletions: bool = False
) -> int:
    """Send the messages of rows that are new or changed since the last publication; returns how many were sent.

    ``send`` gets (key, value) messages, such as ``lambda m: write_topic(m, connection, topic)``. The layer ``state`` holds the key and
    a digest (SHA-256) of every message of the last publication, with the number of copies; it is replaced after sending, so a
    publication that fails is sent again by the next. The first one sends every row. A row that repeats is sent as often as it has
    more copies than before. With ``deletions`` a key that is gone is sent once, with a null value.

    The table is read once, into the working folder; digests are grouped and joined by Spark, the values stay where they are.
    """
    spark = df.sparkSession
    digest = F.sha2(F.col("value"), 256).alias("digest")
    messages = written(encode(df, key).select("key", "value", digest), "publication")
    now = messages.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("copies"))
    if current_version(spark, state) is None:
        last = spark.createDataFrame([], now.schema)
    else:
        last = read_layer(spark, state)
    last = last.select(F.col("key").alias("last_key"), F.col("digest").alias("last_digest"), F.col("copies").alias("last_copies"))
    same = F.col("key").eqNullSafe(F.col("last_key")) & (F.col("digest") == F.col("last_digest"))
    changed = messages.join(last, same, "left_anti").select("key", "value")
    more = now.join(last, same).filter("copies > last_copies").select("key", "digest", (F.col("copies") - F.col("last_copies")).alias("more"))
    more = more.select(F.col("key").alias("more_key"), F.col("digest").alias("more_digest"), "more")
    repeated = messages.dropDuplicates(["key", "digest"]).join(
        more, F.col("key").eqNullSafe(F.col("more_key")) & (F.col("digest") == F.col("more_digest"))
    )
    changed = changed.unionByName(repeated.select("key", "value", F.explode(F.sequence(F.lit(1), F.col("more")))).select("key", "value"))
    if deletions:
        gone = last.join(now.select("key"), F.col("key").eqNullSafe(F.col("last_key")), "left_anti")
        gone = gone.select(F.col("last_key").alias("key")).distinct()
        changed = changed.unionByName(gone.withColumn("value", F.lit(None).cast("string")))
    changed = written(changed, "changes")
    sent = changed.count()
    if sent:
        send(changed)
    replace_layer(now, state)
    return sent


def valid_dimension(df: DataFrame, key: str, numeric_columns: Sequence[str], key_type: str = "string") -> DataFrame:
    """The rows whose measures are numbers, with the measures as doubles and the key as text."""
    kept = keep_numeric(df, numeric_columns)
    return cast_columns(kept, {**{name: "double" for name in numeric_columns}, key: key_type})
