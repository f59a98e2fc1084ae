"""Fingerprints by edit embedding: the walk, the order of documents, verification in tiles."""

import random

import numpy as np
import pytest

from rollcall.llm import edit_prints
from tests.llm import brute

SCHEMA = "doc_id long, text string, id string, at string, stretch string, guest string"
SHORT = [None, "", " ", "a", "ab", "abc", "a b c", "été 中文 \U0001f600 x", "\x00\x00nul", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "the cat sat on the mat " * 4, "the cat sat on the mat " * 4 + "!"]


def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", None) for r in rows], SCHEMA)


def test_digits_together_and_alone():
    rng = random.Random(2)
    texts = [t or "" for t in SHORT] + ["".join(rng.choices("ab cdé中", k=n)) for n in (*range(1, 60, 4), 300, 301)]
    together = edit_prints.Embedder().digits(texts)
    for t, d in zip(texts, together):
        assert "".join(f"{x:x}" for x in d) == brute.edit_print(t)
        assert np.array_equal(edit_prints.Embedder().digits([t])[0], d)


def test_long_text_in_blocks_of_steps(monkeypatch):
    monkeypatch.setattr(edit_prints, "STEPS", 64)
    texts = ["".join(random.Random(k).choices("abcd ", k=400 + k)) for k in range(24)]
    for t, d in zip(texts, edit_prints.Embedder().digits(texts)):
        assert "".join(f"{x:x}" for x in d) == brute.edit_print(t)


@pytest.mark.parametrize("slice_chars", [1, 40, 10**6])
def test_rows(spark, slice_chars):
    rows = [(7 * i % 101 - 20, t) for i, t in enumerate(SHORT * 2)] + [(None, "no id")]
    got = edit_prints.fingerprints(docs(spark, rows).repartition(5), slice_chars=slice_chars).drop("text_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute.edit_prints(rows), key=repr)


def test_few_rows_and_equal_ids(spark):
    one = edit_prints.fingerprints(docs(spark, [(5, "only one here")])).first()
    assert (one.near_next, one.edited_sha256) == (1.0, brute.sha("only on" + "only o"))
    assert edit_prints.fingerprints(docs(spark, [])).collect() == []
    equal = edit_prints.fingerprints(docs(spark, [(1, "same words here")] * 5 + [(1, "other"), (None, None), (None, "x")]))
    got = equal.collect()
    assert len(got) == 8 and len({r.fingerprint for r in got if r.text_sha256 == brute.sha("same words here")}) == 1
    extremes = edit_prints.fingerprints(docs(spark, [(-(2**63), "least"), (None, "none"), (2**63 - 1, "most")]))
    assert sorted(r.n_chars for r in extremes.collect()) == [4, 4, 5]


def edits(text, n, rng):
    text = list(text)
    for _ in range(n):
        i = rng.randrange(len(text))
        text[i : i + rng.randrange(2)] = rng.choice(["", "q", "zz"])
    return "".join(text)


@pytest.mark.parametrize("tile", [512, 4])
def test_near_duplicates(spark, tile):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(300)]
    base = [" ".join(rng.choices(words, k=60)) for _ in range(12)]
    texts = base + [edits(base[k % 3], rng.randrange(1, 6), rng) for k in range(40)] + [base[0]] * 20 + [None, "", None]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    prints = edit_prints.fingerprints(docs(spark, rows))
    by_text = {r.text_sha256: r.fingerprint for r in prints.collect()}
    places = [edit_prints.band_places(b, 128).tolist() for b in range(edit_prints.BANDS)]
    want = brute.near_by_prints([(d, t or "", by_text[brute.sha(t or "")]) for d, t in rows], edit_prints.LEAST, places)
    got = edit_prints.near_duplicates(prints, tile=tile)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert len({c for _, c, _ in want}) < len(set(texts))


def test_recall_of_small_edits():
    """Texts with a few edits are linked; texts of other words are not."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(300)]
    base = [" ".join(rng.choices(words, k=400)) for _ in range(200)]
    digits = edit_prints.Embedder().digits([*base, *(edits(t, 2, rng) for t in base)])
    like = edit_prints.likeness((digits[:200] == digits[200:]).sum(axis=1), 128)
    other = edit_prints.likeness((digits[:200] == np.roll(digits[:200], 1, axis=0)).sum(axis=1), 128)
    assert (like >= edit_prints.LEAST).mean() >= 0.9 and other.max() < 0.3
