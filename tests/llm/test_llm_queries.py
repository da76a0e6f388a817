"""The registered queries over given tables, against SQL or plain versions."""

import collections
import hashlib
import math
import os
import zlib

import brute
import corpus_pipeline
import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from test_operators import VOCABULARY, check_packed
from tokenizers import Tokenizer

import __spark_entry__ as registry
from tiermill.llm import queries as llm

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()


def rows_of(documents):
    return [(d["doc_id"], d["text"]) for d in documents]


def result(spark, name):
    return registry.queries()[name](spark, SF_DIR)


def test_all_are_registered():
    assert set(llm.queries()) <= set(registry.queries()) and set(llm.oracle_sql()) <= set(llm.queries())
    assert {n.split("_")[0] for n in llm.queries()} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
    assert not set(llm.queries()) & set(registry.table_queries())


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, name):
    with duckdb.connect() as connection:
        for table in ("documents", "labels", "benchmark"):
            connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
        expected = connection.sql(llm.oracle_sql()[name])
        columns, rows = sorted(expected.columns), expected.fetchall()
        rows = sorted(tuple(row[expected.columns.index(c)] for c in columns) for row in rows)
    assert sorted(tuple(r) for r in result(spark, name).select(*columns).collect()) == rows


def test_sharding(spark, documents):
    rows = result(spark, "op1_sharding").collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows_of(documents)
    )
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_packing(spark, documents):
    placed = result(spark, "op2_packing")
    expected, pieces, sequences = check_packed(placed, rows_of(documents))
    assert {(i, n) for i, n, _ in expected} == set(pieces)
    library = Tokenizer.from_file(VOCABULARY)
    for doc_id, text in rows_of(documents):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(pieces[doc_id, len(ids)], key=lambda r: r.start):
            assert r.start == at and zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    total = sum(n for _, n, _ in expected)
    assert total / len(sequences) / 1024 > 0.98


def test_quality(spark, documents):
    rows = {r.doc_id: r for r in result(spark, "op3_quality").collect()}
    assert len(rows) == len(documents)
    labels = pq.read_table(f"{SF_DIR}/labels.parquet").to_pylist()
    good = [rows[x["doc_id"]].kept for x in labels if x["quality"] == 1 and x["toxic"] == 0]
    bad = [rows[x["doc_id"]].kept for x in labels if x["quality"] == 0]
    assert np.mean(good) > 0.9 and (not bad or np.mean(bad) < 0.5)


def test_simhash(spark, documents):
    found = sorted((tuple(r) for r in result(spark, "op4_simhash").collect()), key=repr)
    assert found == brute.near_copies(rows_of(documents))


def test_lm_scoring(spark, documents):
    rows = sorted(result(spark, "op6_lm_scoring").collect())
    for r, e in zip(rows, sorted(brute.base_scores(rows_of(documents))), strict=True):
        assert tuple(r)[:5] == e[:5] and r.base_score == pytest.approx(e[5], rel=1e-9) and math.isfinite(r.score)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_bpe(spark, documents):
    library = Tokenizer.from_file(VOCABULARY)
    expected = []
    for doc_id, text in rows_of(documents):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = (np.array(ids, "<u4").tobytes(), decoded.encode())
        expected.append((doc_id, len(ids), *(hashlib.sha256(d).hexdigest() for d in digests)))
    assert sorted(tuple(r) for r in result(spark, "op7_bpe").collect()) == sorted(expected)


def test_license_scan(spark, documents):
    lines = {"GPL-3.0 line": "GNU General Public License, version 3.", "MIT line": "Released under the MIT License."}
    found = collections.Counter((r.doc_id, r.license) for r in result(spark, "op8_license_scan").collect())
    for name, line in lines.items():
        assert {i: n for (i, license_), n in found.items() if license_ == name} == {i: t.count(line) for i, t in rows_of(documents) if line in t}


def test_embedding_dedup(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pylist()][:500]
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in result(spark, "op9_embedding_dedup").collect()}
    assert found == brute.similar_vectors(rows)


def test_substring_dedup(spark, documents):
    found = {r.doc_id: tuple(r)[1:] for r in result(spark, "op10_substring_dedup").collect()}
    assert found == brute.without_repeats(rows_of(documents))


def test_pipeline(spark, documents):
    """Each stage against a plain version of it, on what the stage before kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    judged = {r.doc_id for r in llm.queries()["op3_quality"](spark, SF_DIR).filter("kept").collect()}
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = stage(spark, docs, SF_DIR).cache()
        kept.append(docs.count())
        if name == "packing":
            expected, pieces, _ = check_packed(docs, before)
            assert {(i, n) for i, n, _ in expected} == set(pieces)
            break
        assert docs.columns == columns
        after = dict((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
        if name == "quality classifier":
            assert set(after) == judged
        elif name == "exact dedup":
            largest = {}
            for doc_id, text in before:
                largest[text] = max(doc_id, largest.get(text, -1))
            assert set(after) == set(largest.values())
        elif name == "simhash near-dedup":
            assert set(after) == {c for _, _, c in brute.near_copies(before)}
        else:
            plain = brute.without_repeats(before)
            assert set(after) == set(plain)
            for doc_id, text in after.items():
                assert hashlib.sha256(b" ".join(text.encode().split())).hexdigest() == plain[doc_id][2]
    assert kept[0] < len(documents) and kept[1] < kept[0] and kept[3] == kept[2]
    assert result(spark, "pipeline").count() == kept[4]


def test_odd_documents_pass_the_pipeline(spark, odd_documents, no_documents, tmp_path):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100, 160)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd_documents, no_documents):
        schema = docs.schema
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path)).cache()
            assert docs.schema == schema
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count()
