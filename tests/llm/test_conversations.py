"""Conversation repair against a search of all edits, with spills, across batches, and on awkward rows."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm import conversations
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string, fault string, present string"
ROLES = ["user", "assistant", "system", "User", "", None, "tool", "u"]
SAID = ["Yes.", "No!", "Why?", "cut off", "", " \t", None, "end. ", "fin.\n\x0b", "wide.　", "é?", "…"]


def streamed(rows, spill_chars):
    """One conversation through the streaming class; rows as the brute-force version takes them."""
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(conversations.BLANKS)[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated")
        seen.add((role, text))
    c = conversations._Conversation(1, conversations._Steps(), spill_chars)
    for (turn, role, text), fault in zip(reversed(rows), reversed(faults)):
        c.add(turn, role, text, fault)
    return c


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool"]), st.sampled_from(["A.", "B!", "C", "", "D?", "E"])), max_size=9), st.sampled_from([0, 250, 10**6]))
def test_cheapest_edits(turns, spill_chars):
    rows = [(i, r, t) for i, (r, t) in enumerate(turns)]
    want, kept = brute.repaired(rows)
    c = streamed(rows, spill_chars)
    assert c.summary() == (1, *want, brute.sha("\n".join(f"{r}:{t}" for r, t in kept)))
    assert [(r[4], r[5]) for r in c.repaired()] == list(kept)


def awkward(n):
    rng = random.Random(n)
    return [(rng.choice([1, 2, 3, 4, 5, 6, None]), rng.choice([None, *range(-2, 8)]), rng.choice(ROLES[:3] * 3 + ROLES), rng.choice(SAID), "x", "y") for _ in range(n)]


@pytest.mark.parametrize("n", [1, 12, 60])
def test_awkward_rows(spark, n):
    rows = awkward(n)
    rows += rows[: n // 3]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(r) for r in conversations.repair(conversations.damage(docs)).collect()]
    assert sorted(got, key=repr) == sorted(brute.conversations([r[:4] for r in rows]), key=repr)


def test_long_conversation_spills_over_many_batches(spark):
    """One conversation of thirty thousand turns over Arrow batches of a hundred, with a small spill; its rows come out repaired."""
    rng = random.Random(1)
    rows = [(9, i, rng.choice(["user", "assistant"]), rng.choice(["Fine.", f"No {i}.", f"cut {i}"]), "x", "y") for i in range(30_000)]
    small = [(1, 0, "user", "Hi.", "", ""), (1, 1, "assistant", "Yes.", "", "")]
    docs = spark.createDataFrame([*rows, *small], SCHEMA)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        turns = conversations.repair(docs.drop("present"), turns=True, spill_chars=5_000).collect()
        summary = {r.conv_id: r for r in conversations.repair(docs.drop("present"), spill_chars=5_000).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    whole = streamed([(r[1], r[2], r[3]) for r in rows], 10**9)
    assert tuple(summary[9])[1:] == whole.summary()[1:] and summary[1].audit == "KK"
    own = [r for r in turns if r.conv_id == 9]
    assert [r.place for r in own] == list(range(len(own)))
    assert [r.role for r in own] == ["user", "assistant"] * (len(own) // 2)
    assert brute.sha("\n".join(f"{r.role}:{r.text}" for r in own)) == summary[9].repaired_sha256


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.repair(conversations.damage(empty)).collect() == []
    dropped = next(t for t in range(100) if brute.damaged([(5, t, "user", "x")])[5] == [])
    got = conversations.repair(conversations.damage(spark.createDataFrame([(5, dropped, "user", "x", "", "")], SCHEMA))).first()
    assert tuple(got) == (5, 0, 0, 0, 0, 0, 0, "", brute.sha(""))
