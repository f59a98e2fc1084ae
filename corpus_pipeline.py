"""The pipeline from documents to token ids, in stages that each call one operator.

``documents`` has the columns doc_id, text, lang, source and n_chars, and perhaps more.

1. ``language`` drops documents in no learned language: those without a letter, those with
   more than half of their letters in scripts that no learned language uses, and all if no
   language was learned.
2. ``near_duplicates`` keeps one document of each group of linked fingerprints.
3. ``decontamination`` drops documents that are contaminated by benchmark items.
4. ``secrets`` replaces every secret in a text by a mark, and counts n_chars anew there.
5. ``encoding`` returns the ids of every text, and their number.

Every stage reads all that its predecessor kept, and leaves other rows and columns as
they are. An empty table passes through all stages.
"""

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import decontaminate, language, queries, secret_scan, simhash, word_bpe
from rollcall.operators.small_tables import remove, shared_folder


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_languages(docs, queries.train_language(docs))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs, size_col="n_chars")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = queries.file_bytes(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = word_bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("secrets", hide_secrets),
    ("encoding", encode),
]

#: SQL can express neither the learned model nor the encoding; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    A stage's table is removed when the next one is written; the last one stays.
    """
    docs = queries.table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/rollcall/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
