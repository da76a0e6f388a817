"""Connectors, up to the options they hand to Spark: there is no broker and no database here."""

import pytest

from tiermill.plans.tables import publish_table
from tiermill.sinks.jdbc import append_table, table_sink
from tiermill.sinks.topics import topic_sink
from tiermill.sources.files import working_folder
from tiermill.sources.jdbc import JdbcConnection, KeyRange, read_table
from tiermill.sources.topics import TopicConnection, read_topic
from tiermill.streaming.delivery import fan_out

DB = JdbcConnection("jdbc:mysql://db/olympics", "me", "secret")
BROKER = TopicConnection("broker:9092", "me", 'se"cret')


class Recorder:
    """Stands for a reader or writer and notes what it is told."""

    def __init__(self):
        self.seen = {}
        self.calls = []

    read = readStream = write = property(lambda self: self)

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, name, value):
        self.seen[name] = value
        return self

    def options(self, **given):
        self.seen.update(given)
        return self

    def mode(self, name):
        self.seen["mode"] = name
        return self

    def load(self):
        return self.seen

    def save(self):
        self.calls.append("save")

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "table": table, "predicates": predicates, "properties": properties}


LOGIN = {
    "kafka.bootstrap.servers": "broker:9092",
    "kafka.security.protocol": "SASL_PLAINTEXT",
    "kafka.sasl.mechanism": "PLAIN",
    "kafka.sasl.jaas.config": "org.apache.kafka.common.security.plain.PlainLoginModule required "
    'username="me" password="se\\"cret";',
}
DATABASE = {"url": DB.url, "driver": "com.mysql.cj.jdbc.Driver", "dbtable": "t", "user": "me", "password": "secret"}


def test_topic_options():
    assert BROKER.options() == LOGIN
    assert TopicConnection("b:1").options() == {"kafka.bootstrap.servers": "b:1"}


def test_topic_stream_options():
    assert read_topic(Recorder(), BROKER, "in") == {
        "format": "kafka", **LOGIN, "subscribe": "in", "startingOffsets": "earliest",
    }
    limited = read_topic(Recorder(), BROKER, "in", "latest", max_per_batch=50, min_partitions=64)
    assert limited["startingOffsets"] == "latest"
    assert limited["maxOffsetsPerTrigger"] == "50"
    assert limited["minPartitions"] == "64"


def test_table_scan_options():
    assert read_table(Recorder(), DB, "t") == {"format": "jdbc", **DATABASE}
    split = read_table(Recorder(), DB, "t", KeyRange("id", 1, 1000, 16), fetch_size=10000)
    assert split == {
        "format": "jdbc", **DATABASE, "fetchsize": "10000",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000", "numPartitions": "16",
    }
    parts = read_table(Recorder(), DB, "t", ["id < 5", "id >= 5 or id is null"], fetch_size=7)
    assert parts["predicates"] == ["id < 5", "id >= 5 or id is null"]
    assert (parts["url"], parts["table"]) == (DB.url, "t")
    assert parts["properties"] == {
        "driver": DB.driver, "user": "me", "password": "secret", "fetchsize": "7",
    }


def test_table_append_options():
    writer = Recorder()
    append_table(writer, DB, "t", max_connections=8, batch_size=5000)
    assert writer.seen == {"format": "jdbc", **DATABASE, "numPartitions": "8", "batchsize": "5000", "mode": "append"}
    assert writer.calls == ["save"]


def test_table_sink_can_add_the_batch_number(spark, monkeypatch):
    written = []
    monkeypatch.setattr("tiermill.sinks.jdbc.append_table", lambda df, *rest: written.append((df.collect(), rest)))
    df = spark.createDataFrame([("a",)], "k string")
    table_sink(DB, "t")(df, 3)
    table_sink(DB, "t", batch_column="batch_id", max_connections=2)(df, 3)
    assert [tuple(r) for r in written[0][0]] == [("a",)]
    assert [tuple(r) for r in written[1][0]] == [("a", 3)]
    assert written[1][1] == (DB, "t", 2)


def test_rows_are_sent_as_messages(spark, monkeypatch):
    sent = []
    for module in ("tiermill.sinks.topics", "tiermill.plans.tables"):
        monkeypatch.setattr(f"{module}.write_topic", lambda df, *rest: sent.append((df.collect(), rest)))
    df = spark.createDataFrame([(5, "judo", None)], "id int, sport string, x double")
    topic_sink(BROKER, "out", "sport")(df, 0)
    publish_table(df, "id", BROKER, "results")
    assert [tuple(r) for r in sent[0][0]] == [("judo", '{"id":5,"sport":"judo"}')]
    assert [tuple(r) for r in sent[1][0]] == [("5", '{"id":5,"sport":"judo"}')]
    assert [rest for _, rest in sent] == [(BROKER, "out"), (BROKER, "results")]


def test_secrets_are_not_printed():
    assert "secret" not in repr(DB)
    assert "cret" not in repr(BROKER).replace("me", "")


def test_fan_out_computes_once_and_lets_go(spark):
    df = spark.createDataFrame([(1,)], "x int")
    seen = []
    fan_out(lambda b, i: seen.append((b.is_cached, i)), lambda b, i: seen.append((b.is_cached, i)))(df, 4)
    assert seen == [(True, 4), (True, 4)]
    assert not df.is_cached

    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(RuntimeError):
        fan_out(fail)(df, 5)
    assert not df.is_cached


def test_working_folder_lies_in_the_shared_folder(spark, tmp_path):
    assert working_folder(spark, "x") != working_folder(spark, "x")

    class OnCluster:
        conf = {"spark.checkpoint.dir": f"{tmp_path}/shared/"}

    assert working_folder(OnCluster, "x").startswith(f"{tmp_path}/shared/x-")


def test_working_folder_of_a_cluster_must_be_shared():
    class Session:
        def __init__(self, **conf):
            self.conf = conf

    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError):
            working_folder(Session(**{"spark.master": master}), "x")
    assert working_folder(Session(**{"spark.master": "local[4]"}), "x").rpartition("/")[2].startswith("x-")
