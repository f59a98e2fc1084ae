"""The pipeline stage by stage against what each has to keep."""

import os
import tempfile

import pytest

import corpus_pipeline
from rollcall.llm import queries
from tests.compare import oracle
from tests.llm import brute

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_stages(spark):
    folder = tempfile.mkdtemp(prefix="run-")
    docs = queries.table(spark, SF_DIR, "documents")
    extra = spark.createDataFrame([(10**6, "123 456", None, None, 7), (10**6 + 1, None, None, None, None)], docs.schema)
    foreign = [(10**6 + 2, "Съешь же ещё этих мягких французских булок", None, None, 1), (10**6 + 3, "中文文本 без слов", None, None, 1),
               (10**6 + 4, "The house of the people and the water stands there, тут", None, None, 55)]
    docs, kept = docs.union(extra).union(spark.createDataFrame(foreign, docs.schema)), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        before, docs = docs, spark.read.parquet(f"{folder}/{name}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
        assert len(kept[name]) == docs.count()
        if name != "encoding":
            assert docs.columns == before.columns
    every = {r.doc_id: r.text for r in queries.table(spark, SF_DIR, "documents").collect()}
    # Texts without a letter go, and those mostly in scripts that no labelled text uses.
    assert kept["language"].keys() == {d for d, t in every.items() if any(c.isalpha() for c in t or "")} | {10**6 + 4}
    groups = brute.components([(d, r.text) for d, r in kept["language"].items()])
    assert kept["near_duplicates"].keys() == {c for _, _, c in groups}
    items = oracle(SF_DIR).execute("SELECT item_id, text FROM benchmark").fetchall()
    found = brute.decontamination([(d, r.text) for d, r in kept["near_duplicates"].items()], items)
    assert kept["decontamination"].keys() == {f[0] for f in found if not f[5]}
    assert kept["secrets"].keys() == kept["decontamination"].keys()
    for d, r in kept["secrets"].items():
        assert not any(brute.secrets(r.text)[:3]) and r.n_chars == len(r.text)
    for d, r in kept["encoding"].items():
        assert (r.n_tokens, brute.sha(bytes(r.ids))) == brute.word_bpe(kept["secrets"][d].text)[:2]


def test_empty_table(spark):
    docs = queries.table(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).columns == ["doc_id", "n_tokens", "ids"]
