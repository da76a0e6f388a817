"""Mixes of sources, against plain water filling and sorting."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tiermill.llm import mixing
from tiermill.llm.mixing import mix_sources, mixed_texts, source_targets, word_count


def filled(sizes, weights=(5, 2, 1), budget=1.5, repeats=2):
    """{source: target} of {source: size}, sharing again until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = set(), budget * sum(sizes.values())
    while True:
        left = total - sum(repeats * sizes[s] for s in capped)
        whole = sum(weight[s] for s in order if s not in capped)
        targets = {s: repeats * sizes[s] if s in capped else left * weight[s] / whole for s in order}
        above = {s for s in order if s not in capped and targets[s] > repeats * sizes[s]}
        if not above:
            return targets
        capped |= above


def plain_mix(rows, seed=0, **options):
    """Sorted (doc_id, source, size, source_size, target, taken) of (doc_id, text, source) rows."""
    items = []
    for doc_id, text, source in rows:
        key = ":".join([str(seed), *(str(v) for v in (doc_id, text) if v is not None)])
        items.append((source, hashlib.md5(key.encode()).hexdigest()[:16], doc_id, len(re.findall("[^\x20\x09-\x0d]+", text or ""))))
    sizes = collections.Counter()
    for source, _, _, size in items:
        sizes[source] += size
    targets, used, result = filled(sizes, **options), collections.Counter(), []
    for source, _, doc_id, size in sorted(items, key=lambda i: (i[1], i[2] is not None, i[2] or 0, i[3])):
        full, rest = divmod(int(targets[source] + 0.5), max(sizes[source], 1))
        result.append((doc_id, source, size, sizes[source], targets[source], full * size + max(0, min(size, rest - used[source]))))
        used[source] += size
    return sorted(result, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def close(rows, expected):
    assert [r[:4] + r[5:] for r in rows] == [e[:4] + e[5:] for e in expected]
    assert [r[4] for r in rows] == pytest.approx([e[4] for e in expected], rel=1e-12)


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 5, None: 77, "": 3}, {"a": 0, "b": 0}, {"z": 1}, {"a": 10**12, "b": 1, "c": 1, "é": 10**6, "😀": 9},
    {"a": 0, "b": 100, "c": 100}, {chr(97 + i): (i * 37 % 11) ** 3 for i in range(20)},
])
def test_targets_are_those_of_sharing_again(spark, sizes):
    rows = spark.createDataFrame([(str(s), s, n) for s, n in sizes.items()], "key string, source string, source_size bigint")
    aims = {r.source: r for r in source_targets(rows).collect()}
    expected = filled(sizes)
    assert {s: r.target for s, r in aims.items()} == pytest.approx(expected, rel=1e-12)
    for source, r in aims.items():
        assert r.full * sizes[source] + r.rest == (int(r.target + 0.5) if sizes[source] else 0)


@pytest.mark.parametrize("broadcast", [mixing.BROADCAST_BYTES, -1])
def test_odd_documents(spark, odd_documents, odd_rows, monkeypatch, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", broadcast)
    marked = odd_documents.withColumn("source", F.when(F.col("shard") % 4 > 0, F.concat(F.lit("s"), F.col("shard") % 4)))
    rows = [(r[0], r[1], f"s{n % 4}" if n % 4 else None) for n, r in enumerate(odd_rows)]
    mixed = mix_sources(marked)
    assert mixed.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    close(found(mixed), plain_mix(rows))
    close(found(mix_sources(marked.repartition(5, "row"), weights=(1, 3), budget=0.7, repeats=1, seed=9)),
          plain_mix(rows, seed=9, weights=(1, 3), budget=0.7, repeats=1))


def test_sources_come_to_their_targets_and_larger_mixes_keep_what_smaller_ones_take(spark):
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "repeat('w ', int(id * 7919 % 41)) AS text", "if(id % 3 > 0, 'a', concat('s', id % 7)) AS source"
    )
    taken = {}
    for budget in (0.1, 0.2, 0.9, 1.9):
        rows = mix_sources(docs, budget=budget).collect()
        assert all(0 <= r.taken <= 2 * r.size for r in rows)
        by_source = collections.defaultdict(int)
        for r in rows:
            by_source[r.source, r.target] += r.taken
        assert all(abs(words - target) <= 1 for (_, target), words in by_source.items())
        partial = collections.Counter(r.source for r in rows if r.size and r.taken % r.size)
        assert max(partial.values(), default=0) <= 1
        now = {r.doc_id: r.taken for r in rows}
        assert all(now[i] >= n for i, n in taken.items())
        taken = now


def test_one_row_repeated_very_often_fills_the_target(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES_AT_ONCE", 100)
    rows = [(5, "three short words", "a")] * 1000 + [(n, "one", "b") for n in range(500)] + [(None, None, "a")] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    close(found(mix_sources(docs)), plain_mix(rows))


def test_no_documents_and_documents_without_words(spark, no_documents):
    assert mix_sources(no_documents).count() == 0
    rows = [(1, None, None), (2, "", "a"), (3, " \n", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert {(r.size, r.target, r.taken) for r in mix_sources(docs).collect()} == {(0, 0.0, 0)}


def test_words_are_counted(spark, odd_documents, odd_rows):
    counts = odd_documents.select(word_count(F.coalesce("text", F.lit(""))).alias("n"))
    assert sorted(r.n for r in counts.collect()) == sorted(len(re.findall("[^\x20\x09-\x0d]+", r[1] or "")) for r in odd_rows)


def test_texts_of_a_mix(spark):
    docs = spark.createDataFrame([(n, " a  b c\n", "x") for n in range(5)], "doc_id bigint, text string, source string")
    mixed = mix_sources(docs, budget=1.6)
    texts = mixed_texts(docs, mixed).collect()
    assert sum(len(r.text.split()) for r in texts) == 24 == sum(r.taken for r in mixed.collect())
    assert collections.Counter(r.doc_id for r in texts) == {r.doc_id: -(-r.taken // 3) for r in mixed.collect()}
    assert {r.text for r in texts} <= {" a  b c\n", "a b", "a"}


def test_only_functions_of_dataframes(spark, odd_documents, plan_of):
    assert not any(p in plan_of(mix_sources(odd_documents)) for p in ("Python", "Arrow", "Pandas"))
