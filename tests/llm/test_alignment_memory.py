"""What an executor holds of the alignment: the library's tokenizer, and the batches written and read back."""

import random
from urllib.parse import urlparse

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from rollcall.llm import alignment, queries, token_files
from rollcall.operators.small_tables import materialise
from tests.llm import brute

JSON, MODEL = (queries.file_bytes(P.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def test_tasks_of_a_worker_share_the_tokenizer():
    """Each one used and dropped leaves several MB behind in the library."""
    one, other = (token_files.Encoder(bytes(bytearray(JSON)), P.PATTERN) for _ in range(2))
    assert one.tokenizer is other.tokenizer and one.tokens is not other.tokens
    special = token_files.Encoder(JSON, P.PATTERN, special=True)
    assert special.tokenizer is not one.tokenizer
    assert [e.tokenizer.encode_special_tokens for e in (one, special)] == [True, False]
    assert special.encode(pa.array(["<|endoftext|>"])) != one.encode(pa.array(["<|endoftext|>"]))


@pytest.mark.parametrize("n, width", [(1, 1), (256, 1), (257, 2), (65_536, 2), (65_537, 4)])
def test_places_take_as_few_bytes_as_they_need(n, width):
    places = np.array([0, n - 1, n // 2], dtype=np.int64)
    data = alignment._packed(places, n)
    assert len(data) == 3 * width and alignment._unpacked(pa.py_buffer(data), 3).tolist() == places.tolist()
    assert alignment._packed(places[:0], 0) == b"" and len(alignment._unpacked(pa.py_buffer(b""), 0)) == 0


def test_a_row_group_holds_few_batches(spark, monkeypatch):
    """However many a task makes: one row group of them all would be buffered, and read back, whole."""
    rng, written = random.Random(1), []
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(500)]
    rows = [(i, " ".join(rng.choices(words, k=4_000))) for i in range(24)]
    monkeypatch.setattr(alignment, "WRITTEN", alignment.WRITTEN | {"parquet.block.size": "100000"})
    monkeypatch.setattr(alignment, "materialise", lambda df, **options: written.append(materialise(df, **options)) or written[-1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = alignment.align(docs, JSON, P.PATTERN, MODEL, digest=True, batch_chars=1, slice_chars=1)
    assert sorted(map(tuple, got.collect())) == sorted(brute.alignment(rows))
    groups = [f.metadata.row_group(i).num_rows for f in map(pq.ParquetFile, (urlparse(x).path for x in written[0].inputFiles())) for i in range(f.metadata.num_row_groups)]
    assert sum(groups) == 24 and max(groups) < 12
