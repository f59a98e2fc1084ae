"""Alignment of two tokenizers: end arrays, awkward texts, small batches, empty and clashing tables."""

import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm import alignment, queries
from tests.llm import brute
from tests.llm.test_cases import TEXTS

JSON, MODEL = (queries.file_bytes(P.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
AWKWARD = [
    "</s> <s> <unk> <0x41>", "a▁b", "▁", " ▁ plain", "\x00 nul", "a　 b\xa0 c \x1c", "ﬁ é é ￼", "中文 字 漢字かな", "\U0001f600 \U0001f468‍\U0001f469",
    "tab\tin  two   spaces    four", "x" * 3000 + " y", "the the the", "the the the", "<|endoftext|> and <|endoftext|>", "  \n\n  ",
]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 400)), st.sets(st.integers(1, 400)), st.integers(0, 60))
def test_align_ends(a, b, same):
    a, b = sorted(a), sorted(b | {400 + k for k in range(same)})
    a += [400 + k for k in range(same)]
    a, b = np.unique(np.array(a, dtype=np.int64)), np.array(b, dtype=np.int64)
    at_a, at_b = alignment.align_ends(a, b)
    common = np.intersect1d(a, b)
    assert np.array_equal(a[at_a], common) and np.array_equal(b[at_b], common)


def test_align_ends_of_long_runs():
    """Stretches of a thousand one-to-one tokens, the shift changing between them."""
    gaps = np.ones(50_000, dtype=np.int64)
    ends, rng = np.cumsum(gaps), random.Random(5)
    a, b = (np.delete(ends, sorted(rng.sample(range(49_999), 30))) for _ in range(2))
    at_a, at_b = alignment.align_ends(a, b)
    assert np.array_equal(a[at_a], np.intersect1d(a, b)) and np.array_equal(b[at_b], a[at_a])


@pytest.mark.parametrize("sizes", [{}, {"batch_chars": 300, "slice_chars": 120}, {"batch_chars": 1, "slice_chars": 1}])
def test_awkward_texts(spark, sizes):
    rng = random.Random(3)
    parts = [*"ab ▁\t\n\x0b\x1c　é中", "the", " of", "ing ", "'s", "  ", "1998", "<unk>", "\U0001f600"]
    texts = [t for t in [*TEXTS, *AWKWARD] if len(t or "") < 10_000] + ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(200)]
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts)] + [(7, "again", None, None, None), (None, "no id", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, groups string, key long, pairs string").repartition(3)
    got = alignment.align(docs, JSON, P.PATTERN, MODEL, digest=True, **sizes)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute.alignment([r[:2] for r in rows]), key=repr)


def test_groups_as_text(spark):
    docs = spark.createDataFrame([(1, "hello world"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in alignment.align(docs, JSON, P.PATTERN, MODEL).collect()}
    assert brute.sha(got[1].groups) == brute.alignment([(1, "hello world")])[0][-1] and got[2].groups == ""
    assert got[1].groups.count("|") == got[1].n_groups == got[1].n_links


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs, JSON, P.PATTERN, MODEL).collect() == []
