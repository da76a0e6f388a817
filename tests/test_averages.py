import collections
import datetime
import random

import pytest
from pyspark.sql import functions as F

from tiermill.operators import averages as averages_module
from tiermill.operators.averages import enriched_averages, group_averages, latest_per_key
from tiermill.operators.columns import dedupe
from tiermill.operators.joins import enrich


@pytest.fixture(scope="module")
def skewed(spark):
    """Facts and a dimension in which one key holds a third of the rows on both sides; some keys are null."""
    rng = random.Random(5)

    def key():
        return 7 if rng.random() < 0.34 else rng.choice([None, *range(40)])

    def value():
        return rng.choice([None, rng.randint(-9999, 9999) / 100])

    facts = [(key(), rng.choice(["a", "b", None]), value()) for _ in range(900)]
    dims = [(key(), rng.choice(["x", "y"]), rng.randint(0, 9999) / 100) for _ in range(90)]
    return (
        spark.createDataFrame(facts, "k int, g string, v double").repartition(5),
        spark.createDataFrame(dims, "id int, s string, h double").repartition(3),
        facts,
        dims,
    )


def brute_force(facts, dims):
    by_id = collections.defaultdict(list)
    for i, s, h in dims:
        if i is not None:
            by_id[i].append((s, h))
    groups = collections.defaultdict(lambda: ([], []))
    for k, g, v in facts:
        for s, h in by_id.get(k, []):
            values, heights = groups[g, s]
            heights.append(round(h * 100))
            if v is not None:
                values.append(round(v * 100))

    def average(cents):
        if not cents:
            return None
        total, n = sum(cents), len(cents)
        rounded = (2 * abs(total) + n) // (2 * n)
        return (rounded if total >= 0 else -rounded) / 100

    return {key: (average(v), average(h)) for key, (v, h) in groups.items()}


def averages(facts, dims, reduce_first, exact_scale=2, key_type=None):
    df = enriched_averages(
        facts, dims, ("k", "id"), {"group": "g"}, ["s"], {"av": "v"}, {"ah": "h"},
        key_type=key_type, exact_scale=exact_scale, stamp=None, reduce_first=reduce_first,
    )
    return {(r["group"], r.s): (r.av, r.ah) for r in df.collect()}


@pytest.mark.parametrize("key_type", [None, "string"])
@pytest.mark.parametrize("reduce_first", [False, True])
def test_skewed_join_equals_brute_force(skewed, reduce_first, key_type):
    facts, dims, fact_rows, dim_rows = skewed
    assert averages(facts, dims, reduce_first, key_type=key_type) == brute_force(fact_rows, dim_rows)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_a_key_that_is_hot_on_both_sides_does_not_multiply_out(spark, conf, threshold):
    """A million facts and ten thousand dimension rows share a key: ten billion pairs, never formed."""
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    i = F.col("id")
    facts = spark.range(3_000_000).select(F.when(i % 3 == 0, -1).otherwise(i).alias("k"), (i % 2 / 4).alias("v"))
    dims = spark.range(30_000).select(F.when(i % 3 == 0, -1).otherwise(i).alias("id"), (i % 4 / 2).alias("h"))
    row = enriched_averages(facts, dims, ("k", "id"), [], [], ["v"], ["h"], exact_scale=2, digits=4).first()
    hot, cold = 1_000_000 * 10_000, [k for k in range(30_000) if k % 3]
    v = hot // 2 * 25 + sum(25 * (k % 2) for k in cold)
    h = 1_000_000 * sum(50 * (k % 4) for k in range(0, 30_000, 3)) + sum(50 * (k % 4) for k in cold)
    n = hot + len(cold)
    assert (row.avg_v, row.avg_h) == (round(v / n / 100, 4), round(h / n / 100, 4))


def test_both_ways_agree_in_double_form(skewed):
    facts, dims, _, _ = skewed
    one, two = averages(facts, dims, False, None), averages(facts, dims, True, None)
    assert one.keys() == two.keys()
    for key in one:
        assert one[key] == pytest.approx(two[key], abs=0.011)


def test_two_large_sides_are_reduced_and_merged(skewed, conf, plan_of):
    facts, dims, fact_rows, dim_rows = skewed
    df = enriched_averages(
        facts, dims, ("k", "id"), ["g"], ["s"], ["v"], ["h"], exact_scale=2, stamp=None, reduce_first=True
    )
    plan = plan_of(df)
    join = plan.index("SortMergeJoin")
    assert "Broadcast" not in plan
    assert plan[join:].count("partial_count") == 2
    assert {(r.g, r.s): (r.avg_v, r.avg_h) for r in df.collect()} == brute_force(fact_rows, dim_rows)


def test_small_dimension_is_broadcast_and_facts_stay_in_place(spark, skewed, plan_of, tmp_path):
    facts, dims, _, _ = skewed
    facts.write.parquet(str(tmp_path / "facts"))
    dims.write.parquet(str(tmp_path / "dims"))
    facts, dims = spark.read.parquet(str(tmp_path / "facts")), spark.read.parquet(str(tmp_path / "dims"))
    plan = plan_of(enriched_averages(facts, dims, ("k", "id"), ["g"], ["s"], ["v"], ["h"], stamp=None))
    above, below = plan.split("BroadcastHashJoin")
    assert above.count("Exchange hashpartitioning") == 1
    fact_side, dimension_side = below.split("BroadcastExchange")
    assert "Exchange" not in fact_side and "struct<k:int,g:string,v:double>" in fact_side
    assert "HashAggregate" in dimension_side and "struct<id:int,s:string,h:double>" in dimension_side


def test_small_facts_are_broadcast(spark, skewed, conf, plan_of, tmp_path):
    facts, _, fact_rows, _ = skewed
    facts.write.parquet(str(tmp_path / "facts"))
    height = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 100
    key = (F.col("id") % 50).cast("int")
    wide = spark.range(20_000).select(key.alias("id"), F.lit("x").alias("s"), height.alias("h"))
    wide.write.parquet(str(tmp_path / "dims"))
    facts, dims = spark.read.parquet(str(tmp_path / "facts")), spark.read.parquet(str(tmp_path / "dims"))
    conf("spark.sql.autoBroadcastJoinThreshold", "100KB")
    df = enriched_averages(facts, dims, ("k", "id"), ["g"], ["s"], ["v"], ["h"], exact_scale=2, stamp=None)
    assert "BroadcastHashJoin" in plan_of(df)
    dim_rows = [tuple(r) for r in dims.collect()]
    assert {(r.g, r.s): (r.avg_v, r.avg_h) for r in df.collect()} == brute_force(fact_rows, dim_rows)


def test_underestimated_dimension_is_not_broadcast(spark, conf, plan_of, tmp_path, monkeypatch):
    """Spark's estimate does not see that the dimension multiplies; the count does."""
    spark.range(10).write.parquet(str(tmp_path / "dims"))
    conf("spark.sql.autoBroadcastJoinThreshold", "30KB")
    facts = spark.range(0, 2_000_000).select((F.col("id") % 50_000).cast("int").alias("k"), F.lit(1.0).alias("v"))
    dims = spark.read.parquet(str(tmp_path / "dims"))
    dims = dims.select(F.explode(F.expr("cast(sequence(id * 5000, id * 5000 + 4999) as array<int>)")).alias("id"))
    dims = dims.withColumn("h", F.lit(2.0))
    df = enriched_averages(facts, dims, ("k", "id"), [], [], ["v"], ["h"], exact_scale=2, stamp=None)
    assert "BroadcastHashJoin" in plan_of(df)
    monkeypatch.setattr(averages_module, "BROADCAST_ROWS", 40_000)
    df = enriched_averages(facts, dims, ("k", "id"), [], [], ["v"], ["h"], exact_scale=2, stamp=None)
    assert tuple(df.collect()[0]) == (1.0, 2.0)
    final = plan_of(df).split("Initial Plan")[0]
    assert "SortMergeJoin" in final and "BroadcastHashJoin" not in final


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("reduce_first", [None, False, True])
def test_large_sums_are_exact_in_every_plan(spark, conf, reduce_first, threshold, ansi):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    conf("spark.sql.ansi.enabled", ansi)
    facts = spark.range(20_000).select(F.lit(1).alias("k"), F.lit(1.0e13).alias("v"))
    dims = spark.range(1_000_000).select(F.lit(1).alias("id"), F.lit(1.0e13).alias("h"))
    for left, right in ((facts, dims), (dims.toDF("k", "v"), facts.toDF("id", "h"))):
        df = enriched_averages(
            left, right, ("k", "id"), [], [], ["v"], ["h"], exact_scale=2, stamp=None, reduce_first=reduce_first
        )
        assert tuple(df.first()) == (1.0e13, 1.0e13)


def test_only_named_columns_are_read(spark, plan_of):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    customer = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    plan = plan_of(enriched_averages(events, customer, ("user_id", "c_custkey"), ["event_type"], [], ["value"]))
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan
    assert "ReadSchema: struct<c_custkey:bigint>" in plan
    assert "PushedFilters: [IsNotNull(user_id)]" in plan


def test_null_is_a_group_and_time_is_stamped(spark):
    df = spark.createDataFrame([("g", 1.0), (None, 2.0), (None, 4.0)], "k string, x double")
    at = datetime.datetime(2024, 5, 6, 7, 8, 9)
    rows = {r.k: r for r in group_averages(df, ["k"], ["x"], run_ts=at).collect()}
    assert {k: r.avg_x for k, r in rows.items()} == {"g": 1.0, None: 3.0}
    assert {r.timestamp for r in rows.values()} == {at}
    clock = group_averages(df, ["k"], {"m": "x"}, stamp="run_at")
    assert clock.columns == ["k", "m", "run_at"]
    assert abs((clock.first().run_at - datetime.datetime.now()).total_seconds()) < 86400


def test_enrich_renames_and_drops_null_and_unknown_keys(spark):
    facts = spark.createDataFrame([("1", "p", 5), ("9", "q", 6), (None, "r", 7)], "k string, name string, n int")
    dims = spark.createDataFrame([(1, "one"), (None, "none")], "id int, name string")
    rows = enrich(facts, dims, ("k", "id"), {"fact_name": "name", "n": "n"}, {"dim_name": "name"}, key_type="string")
    assert rows.columns == ["fact_name", "n", "dim_name"]
    assert [tuple(r) for r in rows.collect()] == [("p", 5, "one")]


def test_keys_compared_as_text_or_as_given(spark):
    facts = spark.createDataFrame([("01",)], "k string")
    dims = spark.createDataFrame([(1, "one")], "id int, s string")
    assert enrich(facts, dims, ("k", "id"), ["k"], ["s"]).count() == 1
    assert enrich(facts, dims, ("k", "id"), ["k"], ["s"], key_type="string").count() == 0


def test_latest_per_key(spark):
    written = [("a", 1.0, 0), ("a", None, 2), ("b", 5.0, 1), (None, 7.0, 0), ("a", 3.0, 1)]
    history = spark.createDataFrame(written, "k string, x double, batch_id int")
    rows = {r.k: (r.x, r.batch_id) for r in latest_per_key(history, ["k"]).collect()}
    assert rows == {"a": (None, 2), "b": (5.0, 1), None: (7.0, 0)}


def test_dedupe_merges_copies_before_the_shuffle(spark, plan_of):
    df = spark.range(300).select((F.col("id") % 3).alias("a"), F.lit(None).cast("string").alias("b"))
    once = dedupe(df)
    assert once.count() == 3 and dedupe(once).count() == 3
    plan = plan_of(once)
    assert plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("HashAggregate")


def test_adaptive_execution_splits_a_hot_key_of_a_plain_join(spark, conf, plan_of):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    conf("spark.sql.shuffle.partitions", "16")
    i = F.col("id")
    facts = spark.range(0, 60_000, 1, 6).select(F.when(i % 3 == 0, F.lit(7)).otherwise(i).alias("k"), i.alias("n"))
    dims = spark.range(0, 60_000, 1, 3).select(i.alias("id"), (i * 2).alias("double"))
    joined = enrich(facts, dims, ("k", "id"), ["k", "n"], ["double"])
    joined.collect()
    assert "skew=true" in plan_of(joined)
    assert joined.filter("double = 2 * k").count() == 60_000


def exact_mean(pairs, digits):
    """Half-up mean of (value in units of 10**-2, times) pairs."""
    total, n = sum(v * t for v, t in pairs), sum(t for _, t in pairs)
    sign, units = (-1 if total < 0 else 1), 10 ** (2 - digits)
    return sign * ((2 * abs(total) + n * units) // (2 * n * units)) / 10**digits


@pytest.mark.parametrize("reduce_first", [False, True])
def test_weighted_sums_equal_whole_number_arithmetic(spark, reduce_first):
    """Values of all sizes and both signs, keys repeated unevenly on both sides."""
    rng = random.Random(5)
    # multiples of 2**k hundredths whose doubles are exact
    units = [rng.randint(-(2**45), 2**45) * 2 ** rng.choice([0, 0, 8, 20, 30]) for _ in range(400)]
    facts = [(rng.choice([1, 1, 1, 2, 3, 4]), u) for u in units[:200]]
    dims = [(rng.choice([1, 2, 2, 3, 5]), u) for u in units[200:]]
    per_key = {k: (sum(f == k for f, _ in facts), sum(d == k for d, _ in dims)) for k in range(1, 6)}
    left = spark.createDataFrame([(k, u / 4) for k, u in facts], "k int, v double").repartition(3)
    right = spark.createDataFrame([(k, u / 4) for k, u in dims], "id int, h double").repartition(3)
    row = enriched_averages(left, right, ("k", "id"), [], [], ["v"], ["h"], exact_scale=2, reduce_first=reduce_first).first()
    expected = [
        exact_mean([(u * 25, per_key[k][side]) for k, u in rows if per_key[k][side]], 2)
        for side, rows in ((1, facts), (0, dims))
    ]
    assert (row.avg_v, row.avg_h) == pytest.approx(tuple(expected), rel=1e-15)


def test_no_row_of_an_exact_average_needs_a_decimal(spark, skewed, plan_of):
    facts, dims, _, _ = skewed
    for reduce_first in (False, True):
        df = enriched_averages(
            facts, dims, ("k", "id"), ["g"], ["s"], ["v"], ["h"], exact_scale=2, stamp=None, reduce_first=reduce_first
        )
        partial = [line for line in plan_of(df).lower().splitlines() if "partial_sum" in line]
        assert partial and not any("decimal" in line for line in partial)
