"""What reading the id files back costs an executor."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from rollcall.llm import queries


def test_reading_takes_one_python_worker_a_task(spark, tmp_path):
    texts = ["one two", None, "", "a\tb  c <|endoftext|> é中"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op3_token_files(spark, str(tmp_path))
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    plain, want, start = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json"))), [], 0
    for k, text in enumerate(texts):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((k, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, out.collect())) == want
    assert dict(out.dtypes)["ids_crc32"] == "bigint"
