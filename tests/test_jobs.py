import pytest
from pyspark.sql import functions as F

import run_job
from test_medallion import BIO_COLUMNS, BIOS, RESULT_ROWS, write_csv
from tiermill.operators.messages import encode
from tiermill.plans import athlete_jobs
from tiermill.plans.athletes import BIO, OUTPUT_COLUMNS, RESULT_FIELDS, RESULT_SCHEMA, RESULTS
from tiermill.sinks.files import parquet_sink, write_messages
from tiermill.sources.topics import read_message_folder
from tiermill.streaming.pipelines import start_updates


def test_batch_jobs_one_by_one_and_together(spark, tmp_path, capsys):
    landing = tmp_path / "landing"
    landing.mkdir()
    write_csv(landing / f"{BIO}.csv", BIO_COLUMNS, BIOS)
    write_csv(landing / f"{RESULTS}.csv", RESULT_FIELDS, RESULT_ROWS)
    one, all_in = str(tmp_path / "one"), str(tmp_path / "all")
    run_job.main(["bronze", "--landing", str(landing), "--lake", one])
    run_job.main(["silver", "--lake", one])
    run_job.main(["gold", "--lake", one])
    assert capsys.readouterr().out == ""
    run_job.main(["batch", "--landing", str(landing), "--lake", all_in, "--show"])
    assert "avg_height: double" in capsys.readouterr().out
    gold = [spark.read.parquet(f"{lake}/gold/avg_stats.parquet").drop("timestamp") for lake in (one, all_in)]
    assert gold[0].count() == 3
    assert sorted(gold[0].collect(), key=repr) == sorted(gold[1].collect(), key=repr)


def test_result_stream_keeps_the_missing_medal_null(spark, tmp_path, monkeypatch):
    types = ", ".join(f"{c} {'int' if c == 'athlete_id' else 'string'}" for c in BIO_COLUMNS)
    bio_table = spark.createDataFrame(BIOS, types)
    monkeypatch.setattr(athlete_jobs, "read_table", lambda spark, database, table, split: bio_table)
    bios = athlete_jobs.athlete_bios(spark, None, None)
    assert sorted(r.athlete_id for r in bios.collect()) == ["1", "2", "2", "6"]
    rows = [tuple(None if v is None else str(v) for v in row) for row in RESULT_ROWS]
    write_messages(encode(spark.createDataFrame(rows, RESULT_SCHEMA), "athlete_id"), f"{tmp_path}/in/a")
    averages = athlete_jobs.result_averages(read_message_folder(spark, f"{tmp_path}/in/*"), bios)
    start_updates(averages, [parquet_sink(f"{tmp_path}/out")], f"{tmp_path}/state", available_now=True).awaitTermination()
    found = spark.read.parquet(f"{tmp_path}/out")
    assert found.columns == [*OUTPUT_COLUMNS, "batch_id"]
    groups = {(r.sport, r.medal, r.sex, r.country_noc): (r.avg_height, r.avg_weight) for r in found.collect()}
    assert groups == {
        ("Rowing", "Gold", "Female", "NZL"): (180.0, 70.0),
        ("Rowing", None, "Female", "NZL"): (180.0, 70.0),
        ("Rowing", "Gold", "Male", "CHN"): (170.5, 60.25),
    }


def test_connections_come_from_settings(spark, conf):
    conf("spark.tiermill.jdbc.url", "jdbc:mysql://db/x")
    conf("spark.tiermill.jdbc.user", "me")
    conf("spark.tiermill.jdbc.password", "pw")
    conf("spark.tiermill.topic.servers", "b:1")
    assert run_job.database(spark).options("t") == {
        "url": "jdbc:mysql://db/x", "driver": "com.mysql.cj.jdbc.Driver", "dbtable": "t",
        "user": "me", "password": "pw",
    }
    assert run_job.broker(spark).options() == {"kafka.bootstrap.servers": "b:1"}


@pytest.mark.parametrize(
    "argv, job, called",
    [
        (["publish", "--split", "id", "1", "9", "4"], "publish_results", 1),
        (
            ["stream", "--checkpoint", "c", "--one-task", "--max-per-batch", "50", "--hold", "8", "--hot", "5", "9"],
            "stream_results",
            1,
        ),
        (["tail"], "tail_output", 1),
    ],
)
def test_topic_jobs_are_wired(spark, conf, monkeypatch, argv, job, called):
    conf("spark.tiermill.jdbc.url", "jdbc:mysql://db/x")
    conf("spark.tiermill.topic.servers", "b:1")
    calls = []

    class Query:
        def awaitTermination(self):
            calls.append("awaited")

    monkeypatch.setattr(athlete_jobs, job, lambda *args: calls.append(args) or Query())
    run_job.main(argv)
    assert len([c for c in calls if c != "awaited"]) == called
    if job == "publish_results":
        assert calls[0][3].options()["numPartitions"] == "4"
    else:
        assert "awaited" in calls
    if job == "stream_results":
        assert calls[0][3:] == ("c", None, 50, 8, ["5", "9"], None)


def test_stream_job_builds_its_plan(spark, monkeypatch, tmp_path):
    """The whole job, with a folder in place of the topic and of both sinks."""
    types = "athlete_id int, sex string, height string, weight string"
    bio_table = spark.createDataFrame([(1, "F", "180", "70")], types)
    row = {name: "x" for name in RESULT_SCHEMA.names} | {"athlete_id": "1"}
    df = spark.createDataFrame([tuple(row.values())], RESULT_SCHEMA)
    write_messages(encode(df, F.col("athlete_id")), f"{tmp_path}/in/a")
    written = {}

    def sink(kind):
        return lambda *args: lambda batch, batch_id: written.setdefault(kind, batch.drop("timestamp").collect())

    monkeypatch.setattr(athlete_jobs, "read_table", lambda *args: bio_table)
    monkeypatch.setattr(athlete_jobs, "read_topic", lambda *args, **kw: read_message_folder(spark, f"{tmp_path}/in/*"))
    monkeypatch.setattr(athlete_jobs, "topic_sink", sink("topic"))
    monkeypatch.setattr(athlete_jobs, "table_sink", sink("table"))
    for options in ({"hold": None}, {"hold": 2}, {"hold": 2, "hot": ["1"]}):
        written.clear()
        query = athlete_jobs.stream_results(spark, None, None, None, None, **options)
        query.processAllAvailable()
        query.stop()
        assert [tuple(r) for r in written["topic"]] == [("x", "x", "F", "x", 180.0, 70.0)]
        assert written["topic"] == written["table"]
    spark.catalog.clearCache()


@pytest.mark.parametrize("argv", [["publish"], ["stream", "--one-task"], ["stream", "--checkpoint", "c"]])
def test_reading_and_progress_must_be_stated(argv):
    with pytest.raises(SystemExit):
        run_job.main(argv)


def test_stream_job_holds_the_bios_by_default(spark, monkeypatch, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    bio_table = spark.createDataFrame([(1, "F", "180", "70")], "athlete_id int, sex string, height string, weight string")
    row = {name: "x" for name in RESULT_SCHEMA.names} | {"athlete_id": "1"}
    df = spark.createDataFrame([tuple(row.values())], RESULT_SCHEMA)
    write_messages(encode(df, F.col("athlete_id")), f"{tmp_path}/in/a")
    monkeypatch.setattr(athlete_jobs, "read_table", lambda *args: bio_table)
    monkeypatch.setattr(athlete_jobs, "read_topic", lambda *args, **kw: read_message_folder(spark, f"{tmp_path}/in/*"))
    for name in ("topic_sink", "table_sink"):
        monkeypatch.setattr(athlete_jobs, name, lambda *args: lambda batch, batch_id: batch.count())
    query = athlete_jobs.stream_results(spark, None, None, f"{tmp_path}/state", None, hold=3)
    query.processAllAvailable()
    plan = query._jsq.explainInternal(False)
    query.stop()
    assert "InMemoryTableScan" in plan and "SortMergeJoin" in plan
    spark.catalog.clearCache()


def test_following_stream_finds_hot_athletes_and_changed_bios(spark, monkeypatch, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    types = "athlete_id int, sex string, height string, weight string"
    tables = {BIO: [(1, "F", "180", "70"), (2, "M", "190", "80")], "(v) AS v": [(1,)]}

    def read_table(spark, database, table, split):
        return spark.createDataFrame(tables[table], types if table == BIO else "v int")

    def results(athletes, path):
        rows = [tuple(({name: "x" for name in RESULT_SCHEMA.names} | {"athlete_id": a}).values()) for a in athletes]
        write_messages(encode(spark.createDataFrame(rows, RESULT_SCHEMA).coalesce(1), "athlete_id"), path)

    written = {"topic": [], "table": []}

    def sink(kind):
        return lambda *args: lambda batch, batch_id: written[kind].append(sorted(map(tuple, batch.drop("timestamp").collect())))

    monkeypatch.setattr(athlete_jobs, "read_table", read_table)
    monkeypatch.setattr(athlete_jobs, "read_topic", lambda *args, **kw: read_message_folder(spark, f"{tmp_path}/in/*", 1))
    monkeypatch.setattr(athlete_jobs, "topic_sink", sink("topic"))
    monkeypatch.setattr(athlete_jobs, "table_sink", sink("table"))
    results(["1"] * 9 + ["2"], f"{tmp_path}/in/0")
    options = dict(hold=2, share=0.5, version="(v) AS v", available_now=True)
    query = athlete_jobs.follow_results(spark, None, None, f"{tmp_path}/state", None, **options)
    query.awaitTermination()
    tables[BIO][0], tables["(v) AS v"] = (1, "F", "182", "70"), [(2,)]
    for n in (1, 2):
        results(["1"] * 9, f"{tmp_path}/in/{n}")
    query = athlete_jobs.follow_results(spark, None, None, f"{tmp_path}/state", None, **options)
    query.awaitTermination()
    assert [(g.version, g.hot) for g in query.generations] == [(("2",), ()), (("2",), ("1",))]
    assert written["topic"] == written["table"] == [
        [("x", "x", "F", "x", 180.0, 70.0), ("x", "x", "M", "x", 190.0, 80.0)],
        [("x", "x", "F", "x", 181.0, 70.0)], [("x", "x", "F", "x", 181.33, 70.0)],
    ]
    spark.catalog.clearCache()


@pytest.mark.parametrize("more", [["--trial"], ["--checkpoint", "c", "--fresh"], ["--checkpoint", "c", "--hot", "5"]])
def test_following_needs_a_checkpoint_and_finds_hot_keys_itself(more):
    with pytest.raises(SystemExit):
        run_job.main(["stream", "--one-task", "--follow", *more])


def test_following_and_changes_are_wired(spark, conf, monkeypatch):
    conf("spark.tiermill.jdbc.url", "jdbc:mysql://db/x")
    conf("spark.tiermill.topic.servers", "b:1")
    calls = []

    class Query:
        def awaitTermination(self):
            calls.append("awaited")

    monkeypatch.setattr(athlete_jobs, "follow_results", lambda *args: calls.append(args[3:]) or Query())
    run_job.main(["stream", "--one-task", "--checkpoint", "c", "--follow", "--share", "0.1", "--bio-version", "(q) v"])
    assert calls == [("c", None, None, athlete_jobs.HELD_PARTITIONS, 0.1, "(q) v", None), "awaited"]
    monkeypatch.setattr(athlete_jobs, "publish_results", lambda *args: calls.append(args[3:]))
    run_job.main(["publish", "--one-task", "--changes", "DIR"])
    assert calls[-1] == (None, "DIR")


def test_publishing_changes_of_the_results(spark, monkeypatch, tmp_path):
    sent = []
    rows = [tuple(str(v) for v in row) for row in RESULT_ROWS]
    monkeypatch.setattr(athlete_jobs, "read_table", lambda *args: spark.createDataFrame(rows, RESULT_SCHEMA))
    monkeypatch.setattr(athlete_jobs, "write_topic", lambda messages, broker, topic: sent.append((topic, messages.count())))
    for _ in range(2):
        athlete_jobs.publish_results(spark, None, None, None, str(tmp_path / "state"))
    assert sent == [(RESULTS, len(rows))]
