"""JDBC tables: connection options and the table scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the driver class used when none is given.
DEFAULT_DRIVER = "com.mysql.cj.jdbc.Driver"


@dataclass(frozen=True)
class JdbcConnection:
    """Where a database is and how to log in. Secrets are passed in and are never read from the environment."""

    url: str
    user: str | None = None
    password: str | None = None
    driver: str = DEFAULT_DRIVER

    def __repr__(self) -> str:
        return f"JdbcConnection(url={self.url!r}, user={self.user!r}, driver={self.driver!r})"

    def options(self, table: str) -> dict[str, str]:
        """Options that reader and writer share."""
        given = {"url": self.url, "driver": self.driver, "dbtable": table, "user": self.user, "password": self.password}
        return {name: value for name, value in given.items() if value is not None}


@dataclass(frozen=True)
class KeyRange:
    """Split a scan into ``parts`` queries over equal ranges of a numeric, date or timestamp column.

    The bounds only place the cuts: rows outside them, and nulls, are read by the outermost parts.
    """

    column: str
    lower: int | str
    upper: int | str
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def read_table(
    spark: SparkSession,
    connection: JdbcConnection,
    table: str,
    split: KeyRange | Sequence[str] | None = None,
    fetch_size: int | None = None,
) -> DataFrame:
    """A whole table, its columns and types taken from the database.

    Without ``split`` one task reads everything. For a large table give a :class:`KeyRange`, or a list of
    SQL conditions that together cover every row once (one task each; useful when the key is skewed).
    """
    reader = spark.read.format("jdbc").options(**connection.options(table))
    if fetch_size is not None:
        reader = reader.option("fetchsize", str(fetch_size))
    if split is None:
        return reader.load()
    if isinstance(split, KeyRange):
        return reader.options(**split.options()).load()
    properties = {k: v for k, v in connection.options(table).items() if k not in ("url", "dbtable")}
    if fetch_size is not None:
        properties["fetchsize"] = str(fetch_size)
    return spark.read.jdbc(connection.url, table, predicates=list(split), properties=properties)
