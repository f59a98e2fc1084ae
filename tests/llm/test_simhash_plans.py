"""No join of near duplicates collects a table of the documents in the driver, however small Spark takes it to be."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rollcall.llm import components, simhash
from rollcall.operators.small_tables import materialise
from tests.llm import brute


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    found = []
    for module in (components, simhash):
        monkeypatch.setattr(module, "materialise", lambda df: (found.append(plan(df)), materialise(df))[1])
    return found


def test_replicas_are_shuffled(spark):
    """62 rows a fingerprint: Spark takes them for one, which under 10 MB it broadcast."""
    fps = materialise(spark.range(2_000).select(F.xxhash64("id").alias("fp")))
    found = plan(simhash.links(fps, hot_homes=1))
    assert found.count("SortMergeJoin") == 2  # with the replicas, and with the neighbours looked up
    assert found.count("BroadcastExchange") == 2  # the crowded anchors, at most a row in hot_homes
    replicas = materialise(simhash._replicas(fps, simhash.THRESHOLD))
    assert replicas.count() > 50 * 2_000


def test_written_tables_are_shuffled(spark, plans):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 200)], "a long, b long")
    roots = {r.node: r.root for r in components.connected(edges).collect()}
    assert roots == {**{i: 0 for i in range(1, 51)}, 200: 100}
    assert len(plans) > 3 and not any("BroadcastHashJoin" in p for p in plans)


def test_documents_are_shuffled(spark):
    text = "one two three four five six seven eight nine ten"
    docs = [(1, text), (2, text + " eleven"), (3, text), (4, "other words " * 9), (4, None), (5, ""), (6, "x y z")]
    got = simhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert "Broadcast" not in plan(got)
    want = brute.components(docs)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_stage_of_the_pipeline(spark, plans):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, text), (2, text), (3, "other words " * 9), (None, "x y z"), (5, None)], "doc_id long, text string")
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, "")
    assert any("MapInArrow" in p and "bit_count" in p for p in plans)
    assert not any(re.search("BroadcastHashJoin .*Inner", p) for p in [*plans, plan(kept)])
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "x y z"), (1, text), (3, "other words " * 9), (5, "")]
