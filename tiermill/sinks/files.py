"""File sinks and the preview."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.operators.messages import encode

BatchSink = Callable[[DataFrame, int], None]

# Fixed value: rows shown by a preview.
PREVIEW_ROWS = 10


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace whatever is at ``path`` by ``df``."""
    df.write.mode("overwrite").parquet(path)


def write_messages(messages: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """(key, value) rows as a folder that ``read_message_folder`` can stream."""
    rows = messages.select(F.col("key").cast("string"), F.col("value").cast("binary").alias("value"))
    writer = rows.write.mode("overwrite")
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def batch_folder(path: str, batch_id: int) -> str:
    """Where one micro-batch lies; the folder name reads back as the column ``batch_id``."""
    return f"{path}/batch_id={batch_id}"


def _in_files(batch: DataFrame, files: int | None) -> DataFrame:
    return batch if files is None else batch.repartition(files)


def parquet_sink(path: str, files: int | None = None) -> BatchSink:
    """Micro-batch sink: one folder per batch, so a batch that is run again replaces itself.

    A batch has as many files as the stream has state partitions, unless ``files`` says how many.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_parquet(_in_files(batch, files), batch_folder(path, batch_id))

    return write


def message_folder_sink(path: str, key: str, files: int | None = None) -> BatchSink:
    """Micro-batch sink: the rows as (key, JSON value) messages, one folder per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_messages(_in_files(encode(batch, key), files), batch_folder(path, batch_id))

    return write


def preview(df: DataFrame, rows: int = PREVIEW_ROWS, order_by: str | None = None) -> DataFrame:
    """The first rows of ``df``: any rows, or the lowest by ``order_by``, which makes the choice repeatable."""
    return (df if order_by is None else df.orderBy(order_by)).limit(rows)


def show_preview(df: DataFrame, rows: int = PREVIEW_ROWS) -> None:
    """Print the schema and the first rows."""
    df.printSchema()
    df.show(rows)
