"""Layers in versions: a folder of finished versions and a log that names the current one.

Overwriting a folder in place leaves nothing to read if the job dies half way. Here a new version is written to a folder of
its own, and only when it is complete a record of one row is appended to the layer's log; readers take the newest record. The
record is a single file that Spark's commit puts in place at once, so a reader sees either the old version or the new one. One
job at a time may write a layer.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG, FOLDER = "versions", "version-"
_RECORD = "number bigint, folder string, note string"


@dataclass(frozen=True)
class Version:
    """One finished version of a layer: its folder, and what its writer noted."""

    number: int
    folder: str
    note: str | None


def found_parquet(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """Parquet files of a known schema, or None if nothing is there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The versions in the layer's log, newest first; none for a folder that is no such layer."""
    log = found_parquet(spark, f"{path}/{LOG}", _RECORD)
    rows = [] if log is None else log.orderBy(F.desc("number"), "folder").collect()
    return [Version(**row.asDict()) for row in rows]


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The newest finished version."""
    log = found_parquet(spark, f"{path}/{LOG}", _RECORD)
    rows = [] if log is None else log.orderBy(F.desc("number"), "folder").limit(1).collect()
    return Version(**rows[0].asDict()) if rows else None


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a layer. Versions stay as they are, so what is read does not change under a running job."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no finished version at {path}")
    return spark.read.parquet(f"{path}/{version.folder}")


def next_version(spark: SparkSession, path: str) -> Version:
    """The version to be written next, in a folder of its own."""
    last = current_version(spark, path)
    return Version(last.number + 1 if last else 0, f"{FOLDER}{uuid.uuid4().hex}", None)


def record_version(spark: SparkSession, path: str, version: Version, note: str | None = None) -> Version:
    """Make a version whose files are complete the current one."""
    record = spark.createDataFrame([(version.number, version.folder, note)], _RECORD)
    record.coalesce(1).write.mode("append").parquet(f"{path}/{LOG}")
    return Version(version.number, version.folder, note)


def replace_layer(df: DataFrame, path: str, note: str | None = None) -> Version:
    """Write ``df`` as the layer's next version and make it the current one. ``df`` may read the layer itself.

    If the write fails, or the job dies before the record is there, the layer stays as it was; the unfinished folder is
    never read and goes with the next ``remove_old_versions``.
    """
    spark = df.sparkSession
    version = next_version(spark, path)
    df.write.parquet(f"{path}/{version.folder}")
    return record_version(spark, path, version, note)


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all version folders but those of the newest ``keep`` records, and those that their notes name; returns how many went.

    Keep as many as running jobs may still read. Not while a version is being written.
    """
    if keep < 1:
        raise ValueError("at least the current version is kept")
    kept = versions(spark, path)[:keep]
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in files.listStatus(root) if s.getPath().getName().startswith(FOLDER)]
    old = [folder for folder in old if not any(folder.getName() in f"{v.folder} {v.note}" for v in kept)]
    for folder in old:
        files.delete(folder, True)
    return len(old)
