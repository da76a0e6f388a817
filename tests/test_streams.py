import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tiermill.operators.averages import group_averages, latest_per_key
from tiermill.operators.joins import enrich, hot_keys, salted, spread
from tiermill.operators.messages import encode, string_schema
from tiermill.plans.athletes import DIMENSION_KEYS, FACT_KEYS, KEY, MEASURES, RESULT_SCHEMA
from tiermill.sinks.files import message_folder_sink, parquet_sink, write_messages
from tiermill.sources.topics import read_message_folder
from tiermill.streaming.pipelines import average_messages, hold_dimension, start_updates, tail, tail_to_files

KEYS = [*FACT_KEYS, *DIMENSION_KEYS]
AT = datetime.datetime(2024, 5, 6, 7, 8, 9)


@pytest.fixture(scope="module")
def results(spark):
    """240 results; athlete 7 has a third of them, some medals are null, some athletes unknown."""
    i = F.col("id")
    columns = {name: F.lit("x") for name in RESULT_SCHEMA.names}
    columns["athlete_id"] = F.when(i % 3 == 0, F.lit("7")).otherwise((i % 11).cast("string"))
    columns["medal"] = F.when(i % 4 == 0, F.lit("Gold"))
    columns["sport"] = F.concat(F.lit("s"), (i % 2).cast("string"))
    columns["result_id"] = i.cast("string")
    return spark.range(240).select(*[columns[name].alias(name) for name in RESULT_SCHEMA.names])


@pytest.fixture(scope="module")
def bios(spark):
    i = F.col("id")
    return spark.range(9).select(
        i.cast("string").alias("athlete_id"),
        F.when(i % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("sex"),
        (150 + i * 3.25).alias("height"),
        (50 + i * 1.5).alias("weight"),
    )


@pytest.fixture(scope="module")
def expected(results, bios):
    joined = enrich(results, bios, (KEY, KEY), FACT_KEYS, [*DIMENSION_KEYS, *MEASURES], "string")
    return as_dict(group_averages(joined, KEYS, MEASURES, exact_scale=2, stamp=None))


def as_dict(df):
    return {tuple(r[k] for k in KEYS): (r.avg_height, r.avg_weight) for r in df.collect()}


def publish(messages, path, files):
    for n in range(files):
        part = messages.filter(F.pmod(F.xxhash64("value"), F.lit(files)) == n).coalesce(1)
        write_messages(part, f"{path}/part{n}")


def run(spark, topic, base, dimension, files_per_batch=None, hot=(), copies=8):
    averages = average_messages(
        read_message_folder(spark, f"{topic}/*", files_per_batch), RESULT_SCHEMA, dimension, (KEY, KEY),
        FACT_KEYS, DIMENSION_KEYS, (), MEASURES, exact_scale=2, run_ts=AT, hot=hot, copies=copies,
    )
    sinks = [message_folder_sink(f"{base}/topic", "sport"), parquet_sink(f"{base}/table")]
    query = start_updates(averages, sinks, f"{base}/checkpoint", available_now=True)
    query.awaitTermination()
    return query


@pytest.fixture(scope="module")
def topic(spark, results, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("topic"))
    broken = spark.createDataFrame(
        [("k", "not json"), ("k", '{"athlete_id":'), ("k", None), ("k", "[1]"), ("k", '{"ATHLETE_ID":"7"}')],
        "key string, value string",
    )
    publish(encode(results, KEY).unionByName(broken), path, 3)
    return path


def test_latest_rows_equal_the_batch_answer(spark, topic, bios, expected, tmp_path):
    query = run(spark, topic, tmp_path, bios, files_per_batch=1)
    table = spark.read.parquet(f"{tmp_path}/table")
    assert len({p.batchId for p in query.recentProgress if p.numInputRows}) == 3
    assert as_dict(latest_per_key(table, KEYS)) == expected
    assert any(medal is None for _, medal, _, _ in expected)
    assert {r.timestamp for r in table.select("timestamp").collect()} == {AT}

    # a history: one row per group and batch that touched it, so more rows than groups
    assert table.count() == table.select(*KEYS, "batch_id").distinct().count() > len(expected)

    # both sinks got the same rows
    messages = spark.read.parquet(f"{tmp_path}/topic")
    assert messages.count() == table.count()
    again = encode(table.drop("batch_id"), "sport").select("key", F.col("value").cast("binary"))
    assert messages.select("key", "value").exceptAll(again).count() == 0


def test_restart_goes_on_where_it_stopped(spark, topic, bios, expected, tmp_path):
    run(spark, topic, tmp_path / "out", bios)
    assert spark.read.parquet(f"{tmp_path}/out/table").select("batch_id").distinct().count() == 1
    again = run(spark, topic, tmp_path / "out", bios)
    assert sum(p.numInputRows for p in again.recentProgress) == 0
    assert as_dict(latest_per_key(spark.read.parquet(f"{tmp_path}/out/table"), KEYS)) == expected


def test_state_goes_on_over_a_restart(spark, bios, expected, tmp_path, results):
    messages = encode(results, KEY)
    write_messages(messages.filter(F.col("value").contains('"sport":"s0"')), f"{tmp_path}/in/a")
    run(spark, f"{tmp_path}/in", tmp_path / "out", bios)
    first = as_dict(latest_per_key(spark.read.parquet(f"{tmp_path}/out/table"), KEYS))
    assert 0 < len(first) < len(expected)
    write_messages(messages.filter(F.col("value").contains('"sport":"s1"')), f"{tmp_path}/in/b")
    run(spark, f"{tmp_path}/in", tmp_path / "out", bios)
    assert as_dict(latest_per_key(spark.read.parquet(f"{tmp_path}/out/table"), KEYS)) == expected


def plan_of_last_batch(query):
    return query._jsq.explainInternal(False)


def test_rows_of_hot_keys_are_copied_and_no_others(spark, topic, results, bios, expected, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    hot = hot_keys(results, KEY, share=0.25)
    assert hot == ["7"]
    assert spread(bios, KEY, hot, 8).count() == 9 + 7
    query = run(spark, topic, tmp_path, bios, hot=hot)
    assert "explode(" in plan_of_last_batch(query)
    assert as_dict(latest_per_key(spark.read.parquet(f"{tmp_path}/table"), KEYS)) == expected


def test_equal_messages_of_a_hot_key_take_turns(spark):
    same = spark.range(0, 800, 1, 2).select(F.lit("7").alias("k"))
    counts = same.select(salted(F.col("k"), ["7"], 8)).groupBy("__salt").count().collect()
    assert sorted(r["__salt"] for r in counts) == list(range(8))
    assert min(r["count"] for r in counts) > 50
    assert {r[0] for r in same.select(salted(F.col("k"), ["8"], 8)).distinct().collect()} == {0}


def test_held_dimension_is_not_shuffled_or_sorted_again(spark, topic, bios, expected, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    held = hold_dimension(bios, KEY, 4, ["7"], copies=3)
    try:
        assert held.count() == 11
        query = run(spark, topic, tmp_path, held, hot=["7"], copies=3)
        plan = plan_of_last_batch(query)
        assert "SortMergeJoin" in plan and "InMemoryTableScan" in plan
        assert "AdaptiveSparkPlan" not in plan.split("InMemoryRelation")[0]
        below = plan[plan.index("SortMergeJoin") : plan.index("InMemoryTableScan")]
        # the messages are shuffled and sorted under the join, the dimension is taken as it lies
        assert below.count("Exchange hashpartitioning") == 1
        assert below.count("Sort [") == 1
        assert as_dict(latest_per_key(spark.read.parquet(f"{tmp_path}/table"), KEYS)) == expected
    finally:
        held.unpersist()


def test_duplicates_count_in_the_stream(spark, bios, tmp_path):
    """The stream neither cleans nor drops duplicates."""
    row = {name: "x y" for name in RESULT_SCHEMA.names}
    rows = [{**row, "athlete_id": "1"}, {**row, "athlete_id": "1"}, {**row, "athlete_id": "3"}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], RESULT_SCHEMA)
    write_messages(encode(df, KEY), f"{tmp_path}/in/a")
    run(spark, f"{tmp_path}/in", tmp_path / "out", bios)
    found = as_dict(spark.read.parquet(f"{tmp_path}/out/table"))
    assert found == {("x y", "x y", "x y", "M"): (round((153.25 * 2 + 159.75) / 3, 2), 52.5)}


def test_tail_prints_and_stores_the_text(spark, tmp_path, capsys):
    df = spark.createDataFrame([("k", '{"a":1}'), (None, "é")], "key string, value string")
    write_messages(df, f"{tmp_path}/in/a")
    stream = read_message_folder(spark, f"{tmp_path}/in/*")
    printed = tail(stream, available_now=True)
    printed.awaitTermination()
    assert '{"a":1}' in capsys.readouterr().out
    assert sum(p.numInputRows for p in printed.recentProgress) == 2
    tail_to_files(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", available_now=True).awaitTermination()
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.value for r in stored.collect()) == ['{"a":1}', "é"]


def test_tail_says_how_many_messages_it_leaves_out(spark, tmp_path, capsys):
    df = spark.range(100).select(F.lit("k").alias("key"), F.format_string("m%03d", "id").alias("value"))
    write_messages(df.coalesce(1), f"{tmp_path}/in/a")
    for rows, left in ((30, 70), (100, 0), (1000, 0)):
        tail(read_message_folder(spark, f"{tmp_path}/in/*"), available_now=True, rows=rows).awaitTermination()
        lines = capsys.readouterr().out.split()
        assert sum(line.startswith("m") and line != "more" for line in lines) == 100 - left
        assert ("and 70 more".split() == lines[-3:]) == (left > 0)


def test_a_measure_that_is_no_number_does_not_stop_the_stream(spark, bios, tmp_path):
    schema = string_schema(["athlete_id", "points"])
    values = ['{"athlete_id":"1","points":"abc"}', '{"athlete_id":"1","points":"3"}', '{"athlete_id":"2","points":"x"}']
    rows = spark.createDataFrame([("k", v) for v in values], "key string, value string")
    write_messages(rows, f"{tmp_path}/in/a")
    for scale in (None, 2):
        averages = average_messages(
            read_message_folder(spark, f"{tmp_path}/in/*"), schema, bios, (KEY, KEY), [], ["sex"], ["points"],
            exact_scale=scale, run_ts=AT,
        )
        out = f"{tmp_path}/out{scale}"
        start_updates(averages, [parquet_sink(out)], f"{out}-state", available_now=True).awaitTermination()
        assert {r.sex: r.avg_points for r in spark.read.parquet(out).collect()} == {"M": 3.0, "F": None}


def test_files_per_micro_batch(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("string").alias("k")).repartition(8)
    for batch_id, files in enumerate([None, 2]):
        parquet_sink(f"{tmp_path}/table", files)(df, batch_id)
        message_folder_sink(f"{tmp_path}/topic", "k", files)(df, batch_id)
    for name in ("table", "topic"):
        for batch_id, files in enumerate([8, 2]):
            written = spark.read.parquet(f"{tmp_path}/{name}/batch_id={batch_id}")
            assert written.count() == 100 and len(written.inputFiles()) == files
    parquet_sink(f"{tmp_path}/table", 2)(df, 1)
    assert spark.read.parquet(f"{tmp_path}/table").count() == 200


@pytest.mark.parametrize("name", ["stream_compacted", "stream_followed"])
def test_micro_batches_have_a_file_for_every_core_and_few_state_partitions(spark, tmp_path, monkeypatch, conf, name):
    conf("spark.sql.shuffle.partitions", "40")
    cores, i = spark.sparkContext.defaultParallelism, F.col("id")
    spark.range(0, 2000, 1, 1).select(
        i.alias("event_id"), F.lit(AT).alias("ts"), (i % 50).alias("user_id"), F.concat(F.lit("e"), i % 3).alias("event_type"),
        (i % 40 / 4).alias("value"), F.lit("{}").alias("props"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(0, 40, 1, 1).select(
        i.alias("c_custkey"), F.lit("n").alias("c_name"), (i % 5).cast("int").alias("c_nationkey"),
        (i * 1.25).alias("c_acctbal"), F.lit("S").alias("c_mktsegment"),
    ).write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(registry, "working_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    rows = registry.table_queries()[name](spark, str(tmp_path))
    if name == "stream_compacted":
        assert sorted(rows.collect()) == sorted(registry.gold_avg_stats(spark, str(tmp_path)).collect())
    checkpoint = tmp_path / "stream" / "checkpoint"
    taken = [log.read_text().count('"path"') for log in (checkpoint / "sources" / "0").iterdir() if log.name.isdigit()]
    assert taken == [cores] * registry.MICRO_BATCHES
    assert len([p for p in (checkpoint / "state" / "0").iterdir() if p.name.isdigit()]) == cores < 40
    assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
