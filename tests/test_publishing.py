"""Publishing a table's changes."""

import pytest
from pyspark.sql import functions as F

from tiermill.plans.tables import publish_changes
from tiermill.sources.layers import current_version


@pytest.fixture
def sent():
    return []


def publish(spark, rows, tmp_path, sent, **options):
    """(messages sent this time, their number) of (id, name, weight) rows."""
    df = spark.createDataFrame(rows, "id int, name string, weight double").repartition(3)
    before = len(sent)
    count = publish_changes(df, "id", lambda m: sent.extend(map(tuple, m.collect())), str(tmp_path / "state"), **options)
    assert count == len(sent) - before
    return sorted(sent[before:], key=repr)


ROWS = [(1, "a", 1.5), (2, "b", None), (3, None, 2.0), (None, "no key", 4.0), (2, "b again", 1.0)]
JSON = {
    1: '{"id":1,"name":"a","weight":1.5}', 2: '{"id":2,"name":"b"}', 3: '{"id":3,"weight":2.0}',
}


def test_an_unchanged_table_sends_nothing(spark, tmp_path, sent):
    first = publish(spark, ROWS, tmp_path, sent)
    assert len(first) == 5 and ("1", JSON[1]) in first and ("2", JSON[2]) in first and ("3", JSON[3]) in first
    assert publish(spark, ROWS, tmp_path, sent) == []
    assert publish(spark, ROWS[::-1], tmp_path, sent) == []


def test_only_new_and_changed_rows_are_sent(spark, tmp_path, sent):
    publish(spark, ROWS, tmp_path, sent)
    changed = [(1, "A", 1.5), *ROWS[1:], (9, "new", 0.0)]
    assert publish(spark, changed, tmp_path, sent) == [
        ("1", '{"id":1,"name":"A","weight":1.5}'), ("9", '{"id":9,"name":"new","weight":0.0}')
    ]
    # back again is a change too
    assert publish(spark, ROWS, tmp_path, sent) == [("1", JSON[1])]


def test_copies_and_deletions(spark, tmp_path, sent):
    publish(spark, ROWS[:2], tmp_path, sent)
    assert publish(spark, [*ROWS[:2], ROWS[0], ROWS[0]], tmp_path, sent) == [("1", JSON[1])] * 2
    assert publish(spark, [ROWS[0]], tmp_path, sent, deletions=True) == [("2", None)]
    assert publish(spark, [ROWS[0]], tmp_path, sent, deletions=True) == []
    assert publish(spark, ROWS[:2], tmp_path, sent, deletions=True) == [("2", JSON[2])]
    assert publish(spark, [], tmp_path, sent) == []


def test_a_publication_that_fails_is_sent_again(spark, tmp_path, sent):
    def fail(messages):
        raise OSError("no broker")

    df, state = spark.range(4).withColumn("x", F.lit("y")), str(tmp_path / "state")
    with pytest.raises(OSError):
        publish_changes(df, "id", fail, state)
    assert current_version(spark, state) is None
    assert publish_changes(df, "id", lambda m: sent.extend(m.collect()), state) == 4 == len(sent)
