"""Balanced cuts, on DataFrames in place of a database."""

import pytest
from pyspark.sql import functions as F

from tiermill.sources.cuts import balanced_conditions


def sizes(df, conditions):
    """Rows per condition; every row must be in one."""
    flags = [F.sum(F.when(F.expr(c), 1).otherwise(0)).alias(f"c{n}") for n, c in enumerate(conditions)]
    covered = sum((F.when(F.expr(c), 1).otherwise(0) for c in conditions), F.lit(0))
    row = df.agg(*flags, F.min(covered).alias("least"), F.max(covered).alias("most")).first()
    assert (row.least, row.most) == (1, 1)
    return list(row[: len(conditions)])


def balanced(df, conditions, most=2.0):
    found = sizes(df, conditions)
    assert max(found) <= most * sum(found) / len(found)
    return found


@pytest.fixture(scope="module")
def skewed(spark):
    """100,000 rows: keys crowd towards 0, key 7 has a third, some are null; ids are unique."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 7).when(i % 50 == 1, None).otherwise(F.floor(F.pow(F.lit(10.0), F.rand(3) * 6)))
    return spark.range(100_000).select(i.alias("row_id"), key.cast("bigint").alias("k")).cache()


def test_equal_ranges_would_not_do(skewed):
    width = 10**6 // 20
    found = sizes(skewed, [f"(k < {width} OR k IS NULL)", *[f"k >= {n * width} AND k < {(n + 1) * width}" for n in range(1, 19)], f"k >= {19 * width}"])
    assert max(found) > 10 * sum(found) / len(found)


def test_no_part_holds_over_twice_the_mean(skewed):
    conditions = balanced_conditions(skewed, "k", 20, then="row_id")
    assert 15 <= len(conditions) <= 30
    found = balanced(skewed, conditions)
    assert sum(found) == 100_000


def test_a_heavy_key_stays_whole_without_a_second_column(skewed):
    found = sorted(sizes(skewed, balanced_conditions(skewed, "k", 20)))
    assert found[-1] >= 33_000 and found[-2] <= 2 * sum(found[:-1]) / len(found[:-1])


@pytest.mark.parametrize("make", [
    "CAST(k AS DECIMAL(20,2)) / 4", "DATE '2020-01-01' + CAST(k % 1000 AS INT)", "timestamp_micros(k * 1000007)", "CAST(k AS INT)",
    "CAST(timestamp_micros(k * 1000007) AS TIMESTAMP_NTZ)",
])
def test_types_of_keys(skewed, make):
    made = skewed.select("row_id", F.expr(f"CAST({make} AS DECIMAL(24,4))" if "DECIMAL" in make else make).alias("k"))
    balanced(made, balanced_conditions(made, "k", 8, then="row_id"))


def test_few_rows_one_key_nulls_and_none(spark):
    few = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "row_id int, k int")
    assert sum(sizes(few, balanced_conditions(few, "k", 10))) == 3
    same = spark.range(1000).select(F.col("id").alias("row_id"), F.lit(4).alias("k"))
    balanced(same, balanced_conditions(same, "k", 5, then="row_id"), most=1.5)
    nothing = few.filter("k IS NULL")
    conditions = balanced_conditions(nothing, "k", 4)
    assert len(conditions) == 1 and sizes(few, conditions) == [3]
    assert len(balanced_conditions(few, "k", 1)) == 1


def test_text_is_refused(spark):
    with pytest.raises(TypeError, match="k is string"):
        balanced_conditions(spark.createDataFrame([("a",)], "k string"), "k", 2)
    with pytest.raises(ValueError):
        balanced_conditions(spark.range(3), "id", 0)
