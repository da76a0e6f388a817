"""Batch file sources and the folder for a job's own working files."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


# Working folders of this process that nobody has removed.
_MADE: list[str] = []


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, infer: bool = True
) -> DataFrame:
    """CSV with a header line.

    Without a schema the types are inferred, which reads all the data once more; ``infer=False`` leaves every column
    text and reads the header alone. A schema must name the columns in the order of the file.
    """
    if schema is not None:
        return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    return spark.read.csv(path, header=True, inferSchema=infer)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet file or directory."""
    return spark.read.parquet(path)


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path for files that one task writes and another reads.

    It lies in the shared folder that ``spark.checkpoint.dir`` names. Where that is unset, a session on one machine
    takes a temporary folder, removed when the process ends; a cluster has no such folder that all its machines see, so
    there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = _own_folder()
    path = f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def remove_working_files(spark: SparkSession) -> int:
    """Delete the working folders that this process has asked for so far; returns how many there were.

    Call it when every result has been written elsewhere: DataFrames that still read working files cannot be computed after it.
    """
    removed = 0
    while _MADE:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        removed += folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return removed


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a fresh working folder and read back, so that what follows sees the same rows however often it looks."""
    path = working_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@functools.cache
def _own_folder() -> str:
    """This process's temporary folder; nothing is made until something is written there."""
    folder = f"{tempfile.gettempdir()}/tiermill-{uuid.uuid4().hex}"
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
