"""Documents encoded in blocks against encoding them whole."""

import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators import documents
from rollcall.sources.document_blocks import block_totals, encode_blocks
from rollcall.sources.documents import read_documents

ENDS = ["\n", "\n", "\r\n", "\r", "", "\n\n", "\r\r\n", "\x85", "\x0b"]


@pytest.mark.parametrize("block_bytes", [1, 10, 100, 1 << 20])
def test_blocks_equal_whole_files(spark, tmp_path, block_bytes):
    rng = random.Random(block_bytes)
    folder = tmp_path / "docs"
    folder.mkdir()
    texts = ["a", "\n", "\r", "\r\n", "é", "ab\r", "abc", "abcd\n", *["".join(rng.choice(["", "x", "yé", "中文 words", "z" * 40]) + rng.choice(ENDS) for _ in range(rng.randrange(1, 60))) + "." for _ in range(12)]]
    for i, t in enumerate(texts):
        (folder / f"d{i}.md").write_bytes(t.encode())
    (folder / "bad.txt").write_bytes(b"ok\n\xff\xfe\nmore\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    try:
        encoded = encode_blocks(spark, str(folder), block_bytes).cache()
        rows = encoded.collect()
        totals = {r.file_name: r for r in block_totals(encoded).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = {r.file_name: r for r in documents.encode_files(read_documents(spark, str(folder))).collect()}
    assert totals.keys() == want.keys()
    for name, w in want.items():
        parts = sorted((r.block, r.base64_content) for r in rows if r.file_name == name)
        t = totals[name]
        assert (t.success, t.known_suffix, t.file_size_bytes, t.file_size_readable) == (w.success, w.known_suffix, w.file_size_bytes, w.file_size_readable)
        if w.success:
            assert "".join(p for _, p in parts) == w.base64_content, name
            assert (t.base64_size, t.original_lines) == (w.base64_size, w.original_lines), name
    assert not totals["bad.txt"].success and totals["bad.txt"].base64_size is None


def test_lines_are_shuffled_once(spark, tmp_path):
    from rollcall.sources import document_blocks

    (tmp_path / "a.txt").write_text("x\n" * 10)
    plan = document_blocks._blocks(spark, str(tmp_path), 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
