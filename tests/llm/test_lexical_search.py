"""Ranked search, against scoring every document for every item."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiermill.llm import lexical_search
from tiermill.llm.lexical_search import Heaps, search

FOLDED = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
ITEM_SCHEMA = "item_id bigint, text string, doc_id string"


def terms(text):
    return re.findall(lexical_search.TERM, (text or "").translate(FOLDED))


def plain_search(docs, items, best=10):
    """Sorted (item_id, rank, doc_id, score) of (doc_id, text) and (item_id, text) rows."""
    counted = [(i, collections.Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    number, length = len(counted), sum(n for _, _, n in counted)
    wanted = collections.defaultdict(list)
    for item, text in items:
        wanted[item] += terms(text)
    result = []
    for item, query in wanted.items():
        scores = []
        for doc_id, c, n in counted:
            m, score = 25 + 75 * n * number // length, 0
            for term in query:
                df = sum(term in other for _, other, _ in counted)
                w = math.floor(1000 * math.log((2 * number + 2) / (2 * df + 1)))
                score += w * (1_000_000_000 * c[term] // (1000 * c[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        scores.sort()
        result += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(scores[:best], 1)]
    return sorted(result, key=repr)


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd_items(odd_rows):
    texts = [r[1] for r in odd_rows if r[1]]
    items = [(n, text[:300]) for n, text in enumerate(texts[:30])]
    items += [(3, "more of item three"), (None, texts[12][:80]), (None, "three"), (50, None), (51, ""), (52, " .,; "), (53, "nowhereatall")]
    return items + [(54, "again again AGAIN b"), (55, "😀 naïve x　y"), (56, "Two-words/three")]


@pytest.mark.parametrize("limits", [{}, {"POSTINGS": 100, "CELLS": 64, "ADDITIONS": 200, "LANES": 2}])
def test_odd_documents(spark, odd_documents, odd_rows, odd_items, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(lexical_search, name, value)
    docs = [(r[0], r[1]) for r in odd_rows]
    items = spark.createDataFrame([(i, t, "clashes") for i, t in odd_items], ITEM_SCHEMA).repartition(3)
    assert found(search(odd_documents, items)) == plain_search(docs, odd_items)
    assert found(search(odd_documents.repartition(7), items, best=2)) == plain_search(docs, odd_items, 2)


def test_equal_scores_go_by_id(spark):
    docs = [(n * 37 % 101, "the same text") for n in range(101)] + [(None, "the same text"), (500, "other")]
    items = [(1, "same text"), (2, "OTHER, the")]
    tables = spark.createDataFrame(docs, "doc_id int, text string").repartition(5), spark.createDataFrame(items, "item_id bigint, text string")
    assert found(search(*tables)) == plain_search(docs, items)


@pytest.mark.parametrize("ids", [[None], ["a", None], ["b"]])
def test_items_without_an_id_and_ids_that_are_text(spark, ids):
    docs = [(None, "one two"), (3, "two"), (4, None)]
    items = [(i, "two") for i in ids]
    tables = spark.createDataFrame(docs, "doc_id short, text string"), spark.createDataFrame(items, "item_id string, text string")
    assert found(search(*tables)) == plain_search(docs, items)


def test_nothing_to_find(spark, odd_documents, no_documents):
    one = spark.createDataFrame([(1, "one", "")], ITEM_SCHEMA)
    assert search(no_documents, one).count() == 0
    assert found(search(odd_documents, one.limit(0))) == []
    assert search(odd_documents.withColumn("text", F.lit(" .")), one).count() == 0


def test_ids_that_are_no_integers(spark, odd_documents):
    with pytest.raises(TypeError, match="doc_id must be an integer"):
        search(odd_documents.withColumn("doc_id", F.col("doc_id").cast("string")), spark.createDataFrame([(1, "one", "")], ITEM_SCHEMA))


def test_heaps_keep_the_best_in_any_order():
    rng = np.random.default_rng(3)
    scores, docs = rng.integers(0, 6, (200, 7)), rng.permutation(200)
    known = rng.random(200) > 0.1
    heaps, begin = Heaps(7, 4), 0
    while begin < 200:
        end = begin + int(rng.integers(1, 40))
        heaps.update(scores[begin:end], docs[begin:end], known[begin:end])
        begin = end
    for item in range(7):
        rows = sorted((-s, not k, d) for s, d, k in zip(scores[:, item], docs, known) if s > 0)[:4]
        mine = heaps.item == item
        assert rows == [(-s, not k, d) for s, d, k in zip(heaps.score[mine], heaps.doc[mine], heaps.known[mine])]
