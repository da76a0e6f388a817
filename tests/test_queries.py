"""Every registered query against its SQL, run by DuckDB over the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.table_queries()))
def test_query_equals_sql(spark, tables, name):
    result = registry.table_queries()[name](spark, SF_DIR)
    expected = tables.sql(registry.table_sql()[name])
    assert sorted(result.columns) == sorted(expected.columns)
    ours = _sorted(result.columns, [tuple(row) for row in result.collect()])
    theirs = _sorted(expected.columns, expected.fetchall())
    assert len(ours) > 0
    assert len(ours) == len(theirs)
    for left, right in zip(ours, theirs):
        assert left == right
    assert not any(isinstance(v, float) and math.isnan(v) for row in ours for v in row)


def test_every_query_has_sql():
    assert set(registry.table_queries()) == set(registry.table_sql())


def test_every_query_is_registered():
    assert set(registry.table_queries()) <= set(registry.queries())
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry_runs(spark):
    result = registry.entry(spark)
    assert result.columns == ["event_type", "c_mktsegment", "c_nationkey", "avg_value", "avg_acctbal"]
    assert result.count() > 0
