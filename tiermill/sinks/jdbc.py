"""JDBC append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.sinks.files import BatchSink
from tiermill.sources.jdbc import JdbcConnection


def append_table(
    df: DataFrame,
    connection: JdbcConnection,
    table: str,
    max_connections: int | None = None,
    batch_size: int | None = None,
) -> None:
    """Append the rows to a table. ``max_connections`` limits how many tasks write at the same time."""
    writer = df.write.format("jdbc").options(**connection.options(table))
    if max_connections is not None:
        writer = writer.option("numPartitions", str(max_connections))
    if batch_size is not None:
        writer = writer.option("batchsize", str(batch_size))
    writer.mode("append").save()


def table_sink(
    connection: JdbcConnection, table: str, batch_column: str | None = None, max_connections: int | None = None
) -> BatchSink:
    """Micro-batch sink. ``batch_column`` adds the batch number, by which a batch appended twice can be told."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if batch_column is None else batch.withColumn(batch_column, F.lit(batch_id))
        append_table(rows, connection, table, max_connections)

    return write
