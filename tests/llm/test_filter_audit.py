"""Orders of filters, against walking every order over every row."""

import itertools
import math
import re

import pytest
from pyspark.sql import functions as F

from tiermill.llm.filter_audit import TextRules, edges, filter_audit, paths, text_failures

LABELS = [(100, 1, 0), (101, 0, 1), (101, 1, 0), (103, None, 1), (105, 1, 1), (109, 1, None), (None, 1, 1), (99, 1, 1)]
LABEL_SCHEMA = "doc_id bigint, quality int, toxic int"


def walked(rows, names):
    """{(part, order, step): counts} of (part, failing names, marks...) rows, order by order."""
    result = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        removed_by = dict.fromkeys(names, 0)
        for order in itertools.permutations(names):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                removed_by[f] += len(gone)
                failing, alone = sum(f in r[1] for r in mine), sum(r[1] == {f} for r in mine)
                lost = [sum(r[i] for r in gone) for i in range(2, len(mine[0]))]
                result[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), alone, *lost, f]
        for key, counts in result.items():
            if key[0] == part:
                counts[-1] = removed_by[counts[-1]]
    return {k: tuple(v) for k, v in result.items()}


def plain_failures(rows, labels):
    """(part, failing filters, good, toxic) per (doc_id, text, part) row."""
    result = []
    for doc_id, text, part in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails = {f for f, failed in zip("ABCDE", (
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            re.search("[#$%&*|]", text),
            doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows),
        )) if failed}
        known = [] if doc_id is None else [(q, t) for i, q, t in labels if i == doc_id]
        result.append((part or "", fails, any(q == 1 for q, _ in known), any(t == 1 for _, t in known)))
    return result


def as_found(df, part):
    rows = df.collect()
    found = {(r[part], r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("filters", range(1, 6))
def test_paths_pass_every_state_and_edge_as_orders_do(filters):
    reaching, leaving = paths(filters)
    for state in range(1 << filters):
        used = state.bit_count()
        assert reaching[state] == math.factorial(used) and leaving[state] == math.factorial(filters - used)
    found = edges("ABCDE"[:filters])
    assert len(found) == filters * 2 ** (filters - 1)
    assert all(len(e["steps"]) == e["orders"] for e in found)
    assert sum(e["orders"] for e in found) == filters * math.factorial(filters)


def test_odd_documents(spark, odd_documents, odd_rows):
    marked = odd_documents.withColumn("source", F.when(F.col("shard") % 3 > 0, F.concat(F.lit("s"), F.col("shard") % 3)))
    labels = spark.createDataFrame(LABELS, LABEL_SCHEMA).withColumn("text", F.lit("clashes")).repartition(2)
    rows = [(r[0], r[1], f"s{n % 3}" if n % 3 else None) for n, r in enumerate(odd_rows)]
    audited = filter_audit(text_failures(marked, labels), "ABCDE", "source", ["good", "toxic"], "rows")
    assert audited.columns == [
        "source", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    ]
    assert as_found(audited, "source") == walked(plain_failures(rows, LABELS), "ABCDE")


def test_general_filters_with_nulls_clashing_names_and_no_marks(spark):
    rows = [("x", 1, None, True), ("x", None, None, None), (None, 0, True, False), (None, 1, False, False)] * 3
    df = spark.createDataFrame(rows, "fails string, n int, kept boolean, step boolean").withColumn("n", F.col("n") == 1)
    audited = filter_audit(df, ["n", "kept", "step"], "fails")
    expected = [(p, {f for f, failed in zip(("n", "kept", "step"), r) if failed}) for p, *r in rows]
    plain = {}
    for (part, order, step), counts in walked(expected, ("n", "kept", "step")).items():
        plain[part, order, step] = counts
    assert as_found(audited.withColumnRenamed("fails", "p").select("p", *audited.columns[1:]), "p") == plain


def test_a_part_without_failures_has_zeros_and_no_rows_no_parts(spark, no_documents):
    passing = spark.createDataFrame([("x", False, False)], "part string, A boolean, B boolean")
    assert {tuple(r)[3:] for r in filter_audit(passing, "AB", "part").collect()} == {(1, 0, 0, 0, 0)}
    none = text_failures(no_documents, spark.createDataFrame([], LABEL_SCHEMA))
    assert filter_audit(none, "ABCDE", "source", ["good"], "rows").count() == 0


def test_copies_in_several_parts_fail_but_for_the_first(spark):
    rows = [(7, "same", "b"), (3, "same", "a"), (3, "same", "b"), (None, "same", "a"), (9, "same", "b"), (5, "other", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = text_failures(docs, spark.createDataFrame([], LABEL_SCHEMA)).groupBy("source", "E").agg(F.sum("rows"))
    assert {tuple(r) for r in found.collect()} == {("a", False, 3), ("b", False, 1), ("b", True, 2)}


def test_limits_are_exact():
    rules = TextRules(least_words=4, least_distinct=50, most_capitals=25)
    assert rules.failures(b"a b c", 5)[0] and not rules.failures(b"a b c d", 7)[0]
    assert not rules.failures(b"a a b b", 7)[1] and rules.failures(b"a a a b b", 9)[1]
    assert not rules.failures("Aééé".encode(), 4)[2] and rules.failures("Aéé".encode(), 3)[2]
    assert rules.failures(b"", 0) == (True, False, False, False)


def test_too_many_filters(spark):
    with pytest.raises(ValueError, match="filters"):
        filter_audit(spark.range(1), [f"f{i}" for i in range(9)], "id")
