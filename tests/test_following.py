"""Streams that follow hot keys and a changing dimension, the ledger of the sinks, and compaction of the history."""

import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tiermill.operators.averages import group_averages, latest_per_key
from tiermill.operators.joins import SALT, enrich
from tiermill.operators.messages import encode, string_schema
from tiermill.plans.history import Snapshot, compact_history, latest_state
from tiermill.sinks.files import parquet_sink, write_messages
from tiermill.sources.layers import versions
from tiermill.sources.topics import read_message_folder
from tiermill.streaming.delivery import SinkLedger
from tiermill.streaming.following import FollowingQuery, HeldDimension, KeySketch, files_version
from tiermill.streaming.pipelines import average_messages, start_updates

SCHEMA = string_schema(["k", "sport", "points"])
AT = datetime.datetime(2024, 5, 6, 7, 8, 9)
KEYS = ["sport", "sex"]


def results(spark, first, rows=300, hot="7"):
    """Messages of which a third have one key."""
    i = F.col("id") + first
    key = F.when(i % 3 == 0, hot).otherwise((i % 11).cast("string"))
    return spark.range(rows).select(
        key.alias("k"), F.concat(F.lit("s"), (i % 2).cast("string")).alias("sport"), (i % 40 / 4).cast("string").alias("points")
    )


def bios(spark, factor=1.0):
    i = F.col("id")
    sex = F.when(i % 2 == 0, F.lit("F")).otherwise(F.lit("M"))
    return spark.range(9).select(i.cast("string").alias("k"), sex.alias("sex"), (150 * factor + i * 3.25).alias("height"))


def batch_answer(facts, dimension):
    joined = enrich(facts, dimension, ("k", "k"), ["sport", "points"], ["sex", "height"], "string")
    return as_dict(group_averages(joined, KEYS, ["points", "height"], exact_scale=2, stamp=None))


def as_dict(df):
    return {tuple(r[k] for k in KEYS): (r.avg_points, r.avg_height) for r in df.collect()}


def averages(spark, topic, dimension, files=1, **options):
    return average_messages(
        read_message_folder(spark, f"{topic}/*", files), SCHEMA, dimension, ("k", "k"), ["sport"], ["sex"], ["points"], ["height"],
        exact_scale=2, run_ts=AT, **options,
    )


def publish(facts, path):
    write_messages(encode(facts.coalesce(1), "k"), path)


# --- hot keys -------------------------------------------------------------------------------------


def test_a_key_that_crowds_a_batch_is_spread_from_the_next_one_on(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    for n in range(4):
        publish(results(spark, 300 * n), f"{tmp_path}/in/{n}")
    sketch, plans = KeySketch("k", share=0.2), []

    def build(generation):
        return averages(spark, f"{tmp_path}/in", bios(spark), hot=generation.hot, watch=sketch.watched)

    def look(batch, batch_id):
        plans.append((batch_id, query.generations[-1].hot))

    query = FollowingQuery(spark, build, [look, parquet_sink(f"{tmp_path}/out")], f"{tmp_path}/state", sketch=sketch, available_now=True)
    query.awaitTermination()
    assert plans == [(0, ()), (1, ("7",)), (2, ("7",)), (3, ("7",))]
    assert "explode(" in query.query._jsq.explainInternal(False)
    facts = results(spark, 0, 1200)
    table = spark.read.parquet(f"{tmp_path}/out")
    assert as_dict(latest_per_key(table, KEYS)) == batch_answer(facts, bios(spark))
    assert {r.batch_id for r in table.select("batch_id").distinct().collect()} == {0, 1, 2, 3}


def test_the_sketch_merges_batches_and_forgets_old_ones(spark, tmp_path):
    for n in range(6):
        publish(results(spark, 300 * n, hot="7" if n < 3 else "9"), f"{tmp_path}/in/{n}")
    sketch, hot = KeySketch("k", share=0.2, batches=2, tracked=100), []

    def build(generation):
        return averages(spark, f"{tmp_path}/in", bios(spark), hot=generation.hot, watch=sketch.watched)

    def look(batch, batch_id):
        hot.append(query.generations[-1].hot)
        batch.count()

    query = FollowingQuery(spark, build, [look], f"{tmp_path}/state", sketch=sketch, available_now=True)
    query.awaitTermination()
    # one batch of either key in the window: both have over a fifth
    assert hot == [(), ("7",), ("7",), ("7",), ("7", "9"), ("9",)]
    assert sketch.learn(spark, None) == ("9",)


def test_null_and_rare_keys_are_not_hot(spark, tmp_path):
    rows = results(spark, 0).withColumn("k", F.when(F.col("k") != "7", F.col("k")))
    publish(rows, f"{tmp_path}/in/a")
    publish(rows, f"{tmp_path}/in/b")
    sketch = KeySketch("k", share=0.3)
    query = FollowingQuery(
        spark, lambda g: averages(spark, f"{tmp_path}/in", bios(spark), watch=sketch.watched), [lambda b, _: b.count()], f"{tmp_path}/state",
        sketch=sketch, available_now=True,
    )
    query.awaitTermination()
    assert [g.hot for g in query.generations] == [()]
    with pytest.raises(ValueError):
        KeySketch("k", share=2)


# --- a dimension that changes ---------------------------------------------------------------------


def test_a_bio_changed_between_two_batches_shows_in_the_second(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    table = f"{tmp_path}/bios"
    bios(spark).write.parquet(table)
    held = HeldDimension(lambda: spark.read.parquet(table), "k", 3, lambda: files_version(spark, table))
    publish(results(spark, 0), f"{tmp_path}/in/0")

    def build(generation):
        return averages(spark, f"{tmp_path}/in", held.generation(*generation), hot=generation.hot)

    query = FollowingQuery(spark, build, [parquet_sink(f"{tmp_path}/out")], f"{tmp_path}/state", held.version, available_now=True)
    query.awaitTermination()
    first = as_dict(spark.read.parquet(f"{tmp_path}/out/batch_id=0"))
    assert first == batch_answer(results(spark, 0), bios(spark))

    # the same process: the query is started again on what came in, and finds the table changed
    bios(spark, 2.0).write.mode("overwrite").parquet(table)
    publish(results(spark, 300), f"{tmp_path}/in/1")
    query = FollowingQuery(spark, build, [parquet_sink(f"{tmp_path}/out")], f"{tmp_path}/state", held.version, available_now=True)
    query.awaitTermination()
    both = results(spark, 0, 600)
    plain = {k: v[0] for k, v in batch_answer(both, bios(spark)).items()}
    second = as_dict(spark.read.parquet(f"{tmp_path}/out/batch_id=1"))
    assert {k: v[0] for k, v in second.items()} == plain
    assert all(second[k][1] == pytest.approx((first[k][1] + first[k][1] + 150) / 2, abs=3) for k in first)
    held.release()


def test_the_running_query_swaps_generations(spark, tmp_path, conf):
    """The table changes while the query runs: the batch after is put off and run with the new table."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    table = f"{tmp_path}/bios"
    bios(spark).write.parquet(table)
    for n in range(3):
        publish(results(spark, 300 * n), f"{tmp_path}/in/{n}")
    held = HeldDimension(lambda: spark.read.parquet(table), "k", 3, lambda: files_version(spark, table))
    sketch, seen = KeySketch("k", share=0.25), []

    def build(generation):
        dimension = held.generation(*generation)
        assert SALT in dimension.columns
        return averages(spark, f"{tmp_path}/in", dimension, hot=generation.hot, watch=sketch.watched)

    def change(batch, batch_id):
        seen.append(batch_id)
        batch.count()
        if batch_id == 1:
            bios(spark, 2.0).write.mode("overwrite").parquet(table)

    query = FollowingQuery(
        spark, build, [change, parquet_sink(f"{tmp_path}/out")], f"{tmp_path}/state", held.version, sketch, available_now=True, ledger=True
    )
    query.awaitTermination()
    assert seen == [0, 1, 2]
    assert [bool(g.hot) for g in query.generations] == [False, True, True]
    assert query.generations[1].version != query.generations[2].version
    points = {k: v[0] for k, v in batch_answer(results(spark, 0, 900), bios(spark)).items()}
    last = as_dict(latest_per_key(spark.read.parquet(f"{tmp_path}/out"), KEYS))
    assert {k: v[0] for k, v in last.items()} == points
    unchanged = batch_answer(results(spark, 0, 900), bios(spark))
    assert all(last[k][1] == pytest.approx(unchanged[k][1] + 50, abs=3) for k in last)
    held.release()


def test_a_failure_that_is_none_of_its_own_is_raised(spark, tmp_path):
    publish(results(spark, 0), f"{tmp_path}/in/0")

    def fail(batch, batch_id):
        raise OSError("sink is down")

    query = FollowingQuery(spark, lambda g: averages(spark, f"{tmp_path}/in", bios(spark)), [fail], f"{tmp_path}/state", available_now=True)
    with pytest.raises(StreamingQueryException, match="sink is down"):
        query.awaitTermination()
    assert len(query.generations) == 1


# --- the ledger of the sinks ----------------------------------------------------------------------


def test_a_sink_that_finished_does_not_see_a_batch_again(spark, tmp_path):
    for n in range(3):
        publish(results(spark, 300 * n), f"{tmp_path}/in/{n}")
    seen, down = {"first": [], "second": []}, {1}

    def sink(name):
        def write(batch, batch_id):
            if name == "second" and batch_id in down:
                raise OSError("second is down")
            seen[name].append((batch_id, batch.count()))

        return write

    def run(ledger=True):
        sinks = {name: sink(name) for name in seen}
        df = averages(spark, f"{tmp_path}/in", bios(spark))
        return start_updates(df, sinks, f"{tmp_path}/state", available_now=True, ledger=ledger)

    with pytest.raises(StreamingQueryException, match="second is down"):
        run().awaitTermination()
    assert [n for n, _ in seen["first"]] == [0, 1] and [n for n, _ in seen["second"]] == [0]
    with pytest.raises(StreamingQueryException):  # once more while it is down: the first is left alone
        run().awaitTermination()
    assert [n for n, _ in seen["first"]] == [0, 1]
    down.clear()
    run().awaitTermination()
    assert [n for n, _ in seen["first"]] == [0, 1, 2] and seen["first"] == seen["second"]


def test_without_a_ledger_it_does(spark, tmp_path):
    publish(results(spark, 0), f"{tmp_path}/in/0")
    seen, down = [], [True]

    def fail(batch, batch_id):
        if down:
            raise OSError("down")

    for _ in range(2):
        query = start_updates(averages(spark, f"{tmp_path}/in", bios(spark)), [lambda b, n: seen.append(n), fail], f"{tmp_path}/state", True)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            down.clear()
    assert seen == [0, 0]
    with pytest.raises(ValueError, match="checkpoint"):
        start_updates(averages(spark, f"{tmp_path}/in", bios(spark)), [fail], None, ledger=True)


def test_records_are_bounded_and_survive_a_half_written_one(spark, tmp_path):
    ledger = SinkLedger(str(tmp_path / "sinks"))
    assert ledger.finished(spark, "a") == -1
    for n in (7, 8, 9):
        ledger.record(spark, "a", n)
    assert ledger.finished(spark, "a") == 9 and ledger.finished(spark, "b") == -1
    assert sorted(p.name for p in (tmp_path / "sinks" / "a").iterdir()) == ["slot=0", "slot=1"]
    for part in (tmp_path / "sinks" / "a" / "slot=0").iterdir():  # the record of 10 was being written in place of that of 8
        part.unlink()
    assert ledger.finished(spark, "a") == 9


def test_a_batch_that_all_sinks_finished_only_brings_the_state_up(spark, tmp_path):
    """The stream died after its sinks and before its own commit: they see nothing again, and no message is lost from the state."""
    for n in range(2):
        publish(results(spark, 300 * n), f"{tmp_path}/in/{n}")
    calls, out = [], f"{tmp_path}/out"

    def run():
        sinks = {"seen": lambda batch, n: calls.append(n), "table": parquet_sink(out)}
        query = start_updates(averages(spark, f"{tmp_path}/in", bios(spark)), sinks, f"{tmp_path}/state", True, ledger=True)
        query.awaitTermination()

    run()
    for file in (tmp_path / "state" / "commits").iterdir():
        if file.name.lstrip(".").startswith("1"):
            file.unlink()
    publish(results(spark, 600), f"{tmp_path}/in/2")
    run()
    assert calls == [0, 1, 2]
    assert as_dict(latest_per_key(spark.read.parquet(out), KEYS)) == batch_answer(results(spark, 0, 900), bios(spark))


# --- compaction -----------------------------------------------------------------------------------


def write_batches(spark, path, batches, rows=60):
    for n in batches:
        i = F.col("id")
        df = spark.range(n, n + rows).select(
            F.when(i % 13 > 0, (i * 7 % 29).cast("string")).alias("a"), (i % 3).alias("b"), F.when(i % 5 > 0, i * 100 + n).alias("x")
        )
        parquet_sink(path)(df.dropDuplicates(["a", "b"]), n)


def state(df):
    return sorted(map(tuple, df.select("a", "b", "x", F.col("batch_id").cast("bigint")).collect()), key=repr)


def test_snapshot_and_tail_equal_the_whole_history(spark, tmp_path):
    history, snapshot, keys = f"{tmp_path}/history", f"{tmp_path}/snapshot", ["a", "b"]
    throughs = []
    for batches in (range(1), range(1, 4), range(4, 5), range(5, 9)):
        write_batches(spark, history, batches)
        whole = state(latest_per_key(spark.read.parquet(history), keys))
        assert state(latest_state(spark, history, snapshot, keys)) == whole
        found = compact_history(spark, history, snapshot, keys, buckets=5)
        throughs.append(found.through if found else None)
        assert state(latest_state(spark, history, snapshot, keys)) == whole
    assert throughs == [None, 2, 3, 7]
    compact_history(spark, history, snapshot, keys, through=8)
    merged = Snapshot.of(spark, snapshot)
    assert merged.through == 8 and merged.buckets == 5 and state(merged.rows(spark, snapshot)) == whole
    assert compact_history(spark, history, snapshot, keys) == merged


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    history, snapshot, keys = f"{tmp_path}/history", f"{tmp_path}/snapshot", ["a", "b"]
    write_batches(spark, history, range(2))
    first = compact_history(spark, history, snapshot, keys, buckets=16, through=1)
    write_batches(spark, history, [2], rows=2)
    second = compact_history(spark, history, snapshot, keys, through=2)
    changed = {b for b in second.folders if second.folders[b] != first.folders.get(b)}
    assert 1 <= len(changed) <= 2 and len(second.folders) > 5
    assert state(latest_state(spark, history, snapshot, keys)) == state(latest_per_key(spark.read.parquet(history), keys))


def test_a_compaction_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    from tiermill.plans import history as module

    history, snapshot, keys = f"{tmp_path}/history", f"{tmp_path}/snapshot", ["a", "b"]
    write_batches(spark, history, range(4))
    compact_history(spark, history, snapshot, keys, through=1)

    def die(*args):
        raise OSError("killed")

    monkeypatch.setattr(module, "record_version", die)
    with pytest.raises(OSError):
        compact_history(spark, history, snapshot, keys, through=3)
    assert len(versions(spark, snapshot)) == 1
    assert state(latest_state(spark, history, snapshot, keys)) == state(latest_per_key(spark.read.parquet(history), keys))
