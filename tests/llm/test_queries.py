"""Every query against brute force over whole given tables."""

import os
import zlib

import duckdb
import pytest

from rollcall.llm.queries import CHECKS, QUERIES
from tests.compare import compare, oracle
from tests.llm import brute

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def rows(sql):
    return oracle(SF_DIR).execute(sql).fetchall()


DOCS, PAGES, ITEMS = "SELECT doc_id, text FROM documents", "SELECT page_id, html FROM pages", "SELECT item_id, text FROM benchmark"
WANTED = {
    "op1_quality": lambda: [(d, *brute.quality(t)) for d, t in rows(DOCS)],
    "op2_licenses": lambda: [(d, *brute.licenses(t)) for d, t in rows(DOCS)],
    "op3_token_files": lambda: brute.token_files(rows(DOCS)),
    "op4_simhash": lambda: brute.components(rows(DOCS)),
    "op5_warc": lambda: brute.warc(rows(PAGES)),
    "op6_secrets": lambda: [(d, *brute.secrets(t)[:4]) for d, t in rows(DOCS)],
    "op7_decontamination": lambda: brute.decontamination(rows(DOCS), rows(ITEMS)),
    "op9_word_bpe": lambda: [(d, *brute.word_bpe(t)) for d, t in rows(DOCS)],
    "op11_alignment": lambda: brute.alignment(rows(DOCS)),
    "op13_conversations": lambda: brute.conversations(rows("SELECT conv_id, turn, role, text FROM conversations")),
}


@pytest.mark.parametrize("name", list(WANTED))
def test_query_equals_brute_force(spark, name):
    want = WANTED[name]()
    got = [tuple(r)[: len(want[0])] for r in QUERIES[name](spark, SF_DIR).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_equals_check(spark, name):
    assert compare(spark, oracle(SF_DIR), name, QUERIES[name], CHECKS[name], SF_DIR) is None


def test_language_on_held_out_rows(spark):
    lang = dict(rows("SELECT doc_id, lang FROM documents"))
    got = QUERIES["op10_language"](spark, SF_DIR).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)


def test_language_equals_brute_force(spark):
    """Training and walk written plainly over the whole table; scores to the precision of the model's numbers."""
    given = rows("SELECT doc_id, text, lang FROM documents")
    model = brute.language_model([(t, lang) for d, t, lang in given if t is not None and lang is not None and zlib.crc32(str(d).encode()) % 5])
    got = {r.doc_id: r for r in QUERIES["op10_language"](spark, SF_DIR).collect()}
    for d, text, _ in given:
        lang, score = brute.language(text, model)
        assert got[d].lang_pred == lang and got[d].score == pytest.approx(score, abs=1e-3), d


def test_fingerprints_of_all_documents(spark):
    """Every text walked as a whole; the slow walk of the brute-force version is run on the shorter ones."""
    docs = sorted((d, t or "") for d, t in rows(DOCS))
    got = {r.doc_id: r for r in QUERIES["op12_fingerprints"](spark, SF_DIR).collect()}
    assert sorted(got) == [d for d, _ in docs]
    for (d, text), (after, following) in zip(docs, docs[1:] + docs[:1]):
        r, half = got[d], len(text) // 2
        new = text[: len(text) - half] + following[:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), brute.sha(new))
        assert r.near_edited == pytest.approx(brute.print_likeness(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(brute.print_likeness(r.fingerprint, got[after].fingerprint))
        if len(text) < 250:
            assert (r.fingerprint, r.edited_fingerprint) == (brute.edit_print(text), brute.edit_print(new))
    assert sum(r.near_edited > r.near_next for r in got.values() if r.n_chars > 20) >= 0.95 * sum(r.n_chars > 20 for r in got.values())


def test_driver_entry_registers_all(spark):
    import __spark_entry__ as driver

    assert {*QUERIES, "pipeline"} <= driver.queries().keys()
    assert CHECKS.keys() <= driver.oracle_sql().keys()
