"""What the operators share: written intermediate tables, row numbers, and joining decisions back to documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.sources.files import working_folder

# Rows of a few numbers that are worth a partition and a file of their own.
ROWS_IN_FILE = 1 << 17


def staged(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """``df`` written to the shared working folder and read back; ``compression`` is one of parquet's, or Spark's setting.

    Cuts the lineage: what follows reads the files, also after the loss of an executor.
    """
    path = working_folder(df.sparkSession, purpose)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fitted(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has so many rows at most, in no more partitions than they fill.

    So few rows are not written as a file per shuffle partition, each of which costs tasks, requests and, on a local disk,
    processes that set its permissions.
    """
    return df.coalesce(1 + rows // ROWS_IN_FILE)


def full_text(column: Column | str = "text") -> Column:
    """The whole text, a null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def buckets_before(counted: DataFrame, bucket: str, weight: Column) -> DataFrame:
    """(bucket, before, total): how much lies in the buckets before each one, and in all.

    One row per bucket, so as many rows as there are buckets whatever the size of the data.
    """
    sums = counted.groupBy(bucket).agg(F.sum(weight).alias("__in"))
    everything = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        bucket,
        F.coalesce(F.sum("__in").over(earlier), F.lit(0)).cast("bigint").alias("before"),
        F.sum("__in").over(everything).cast("bigint").alias("total"),
    )


def giving_way(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` with its columns of these names (whatever their case) called ``<name>_in``, or ``<name>_in_in`` and so on."""
    taken = {c.lower() for c in df.columns} | {n.lower() for n in names}
    renamed = []
    for column in df.columns:
        name = column
        while name.lower() in {n.lower() for n in names} or (name != column and name.lower() in taken):
            name += "_in"
        taken.add(name.lower())
        renamed.append(name)
    return df.toDF(*renamed)


def one_row_each(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row of ``docs`` for each (doc_id, text_sha256) of ``chosen``, which must not repeat; null ids match.

    Of rows that repeat both, the one whose other columns have the smallest hash stays, so that a rerun gives the same rows.
    They collapse before the shuffle, so a row repeated any number of times is no hot key; the rows are shuffled once, by
    the key under which they are then joined.
    """
    plain = [c for c in docs.schema.fields if not any(k in c.dataType.simpleString() for k in ("map<", "variant"))]
    order = F.xxhash64(*[F.col("`" + c.name.replace("`", "``") + "`") for c in plain])

    def key(sha: Column) -> Column:
        known = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("-"))
        return F.coalesce(F.concat(known, F.lit(":"), sha), F.lit(""))  # never null: no look for nulls, which would digest twice

    keyed = docs.select(F.struct("*").alias("doc"), key(text_sha256(F.col("text"))).alias("key"), order.alias("order"))
    first = keyed.groupBy("key").agg(F.min_by("doc", "order").alias("doc"))
    kept = chosen.select(key(F.col("text_sha256")).alias("key"))
    return first.join(kept, "key", "left_semi").select("doc.*")


def text_sha256(text: Column) -> Column:
    return F.sha2(F.encode(full_text(text), "UTF-8"), 256)


def extended(schema: T.StructType, more: str) -> T.StructType:
    """``schema`` and the fields of the DDL text ``more``, as a new schema."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(more).fields])
