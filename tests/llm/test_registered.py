"""Every registered query over the whole smallest tables, against SQL or a brute-force version."""

import hashlib

import duckdb
import numpy as np
import pytest
from test_bpe import digest
from test_dedup import brute as components
from test_dedup import shingles
from test_divergence import brute as divergence
from test_fingerprints import edited
from test_personal import base as personal, written
from test_quality import brute as statistics
from test_secrets import base, digest as span_digest
from test_tokens import check_packing, library
from test_trie import brute as trie
from test_warc import expected

import __spark_entry__ as entry_points
from wireloom.llm import block_extract, packing, skip_chain_crf
from wireloom.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())


@pytest.fixture(scope="module")
def pages():
    return duckdb.sql(f"SELECT page_id, url, html FROM '{FOLDER}/pages.parquet'").fetchall()


def rows(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


def test_names():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


def test_op1(spark, pages):
    assert sorted((tuple(r)[:5] for r in rows(spark, "op1_warc_segments")), key=repr) == expected(pages)


def test_op2(spark, docs):
    check_packing(rows(spark, "op2_best_fit_packing"), packing.Capacity(), docs)


def test_op3(spark, docs):
    got = {r["doc_id"]: r for r in rows(spark, "op3_quality_mcd")}
    assert set(got) == set(docs)
    for doc_id, text in docs.items():
        n, *rest = statistics(text)
        r = got[doc_id]
        assert [r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]] == [n, *rest]
        assert r["base_failed"] == (n < 20 or 100 * rest[-1] > 30 * n) and not (r["base_failed"] and r["kept"])


def test_op4(spark, docs):
    for r in rows(spark, "op4_markov_secrets"):
        assert r["base_sha256"] == span_digest(base(docs[r["doc_id"]]))


def test_op5(spark, docs):
    import hashlib

    got = {r["doc_id"]: r for r in rows(spark, "op5_order_minhash")}
    ids = sorted(docs)
    for doc_id, follow in zip(ids, [*ids[1:], ids[0]], strict=True):
        text = edited(docs[doc_id] or "", docs[follow] or "")
        assert got[doc_id]["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    by_text = {}
    for doc_id, text in docs.items():
        assert by_text.setdefault(text, got[doc_id]["fingerprint"]) == got[doc_id]["fingerprint"]
    assert np.mean([r["near_edited"] for r in got.values()]) > 5 * np.mean([r["near_next"] for r in got.values()])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    con = duckdb.connect()
    for table in ("pages", "documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    assert sorted(map(tuple, frame.collect())) == sorted(con.execute(f"SELECT {', '.join(frame.columns)} FROM ({ORACLES[name]})").fetchall())


def test_op7(spark, pages):
    want = {page_id: block_extract.main_text(html) for page_id, _, html in pages}
    assert {r["page_id"]: r["text"] for r in rows(spark, "op7_block_extract")} == want


def test_op8(spark, docs):
    got, start = {r["doc_id"]: r for r in rows(spark, "op8_token_files")}, 0
    for doc_id in sorted(docs):
        n = len(library(docs[doc_id] or "")) + 1
        assert (got[doc_id]["start"], got[doc_id]["n_tokens"]) == (start, n)
        start += n


def test_op9(spark, docs):
    assert {tuple(r) for r in rows(spark, "op9_segment_tree_bpe")} == {(i, *digest(t)) for i, t in docs.items()}


def test_op10(spark, docs):
    want = components(list(docs.items()))
    for r in rows(spark, "op10_minmax_dedup"):
        assert r["component_id"] == want[r["doc_id"]] and r["n_shingles"] == len(shingles(docs[r["doc_id"]]))


def test_op11(spark, docs):
    for r in rows(spark, "op11_skip_chain_crf"):
        own = personal(docs[r["doc_id"]])
        assert [r[f"n_{kind}"] for kind in skip_chain_crf.KINDS] == [sum(s[0] == k for s in own) for k in range(4)]
        told = written(own)
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert set(filter(None, told.split(","))) <= set(r["spans"].split(","))


def test_op12(spark):
    turns = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{FOLDER}/conversations.parquet'").fetchall()
    assert sorted(tuple(r) for r in rows(spark, "op12_prefix_trie")) == trie(turns)


def test_op13(spark):
    told = duckdb.sql(f"SELECT text, lang, source FROM '{FOLDER}/documents.parquet'").fetchall()
    assert sorted(tuple(r) for r in rows(spark, "op13_source_skyband")) == divergence(told)
