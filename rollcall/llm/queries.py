"""The registered queries of this subpackage, and check SQL where SQL can express them.

Where there is none, ``tests/llm`` holds the query against a brute-force version.
"""

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.checks import CHECKS  # noqa: F401
from rollcall.llm import (
    alignment, conversations, decontaminate, edit_prints, language, licenses, quality, secret_scan, simhash, token_files, url_lists, warc, word_bpe,
)
from rollcall.operators.small_tables import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder."""
    return f"{shared_folder(spark)}/rollcall/{name}-{uuid.uuid4().hex}"


def file_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_lines(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "ids")
    vocabulary = file_bytes(public_tokenizers.path("byte_bpe_50k.json"))
    token_files.write_ids(table(spark, sf_dir, "documents"), path, vocabulary, public_tokenizers.PATTERN, special=True)

    read = token_files.read_ids(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"), path_col="doc_id", content_col="text")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secret_scan.RULES if r.base]))
    return found.select(
        F.col("path").alias("doc_id"), *[count(r.kind) for r in secret_scan.RULES if r.base],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.verdicts(found).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated")


def dated_lists(pages: DataFrame) -> DataFrame:
    """List entries for the hosts of the pages: no table has any, so rules over a hash make them."""
    host = url_lists.host_of(F.col("url"))
    hosts = pages.select(host.alias("host")).filter("host IS NOT NULL").distinct()
    hosts = hosts.withColumn("h", F.conv(F.substring(F.md5("host"), 1, 4), 16, 10).cast("int"))
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n)
    entry = lambda name, key, action, since: F.struct(F.lit(name).alias("list"), key.alias("key"), F.lit(action).alias("action"), since.alias("since"))
    h, parent = F.col("h"), F.substring_index("host", ".", -2)
    entries = F.array(
        F.when(h % 3 == 0, entry("hosts", F.col("host"), "block", day(h % 200))),
        F.when(h % 3 == 0, entry("hosts", F.col("host"), "remove", day(h % 200 + 90))),
        F.when(h % 6 == 0, entry("hosts", F.col("host"), "block", day(h % 200 + 120))),
        F.when(h % 4 == 1, entry("paths", F.concat("host", F.lit("/en")), "block", day(F.lit(50) + h % 50))),
        F.when(h % 5 == 0, entry("paths", F.concat("host", F.lit("/de")), "allow", day(F.lit(100)))),
        F.when(h % 7 == 0, entry("domains", parent, "block", day(h % 300))),
        F.when(h % 7 == 1, entry("domains", parent, "remove", day(h % 300))),
    )
    return hosts.select(F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e")).select("e.*")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366).cast("int"))
    return url_lists.apply_lists(pages.select("page_id", "url", fetched.alias("fetched")), dated_lists(pages))


def op9_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = file_bytes(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = word_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return word_bpe.decode(coded, ranks).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def in_fold(key) -> F.Column:
    """Whether the row is held out of training."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def train_language(docs: DataFrame) -> language.Model:
    """Learn from the rows that are not held out; a row without an id is."""
    return language.train(docs.filter(~in_fold("doc_id")))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, train_language(docs))
    return found.select("doc_id", in_fold("doc_id").alias("held_out"), "lang_pred", "score")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(
        table(spark, sf_dir, "documents"), file_bytes(public_tokenizers.path("byte_bpe_50k.json")), public_tokenizers.PATTERN,
        file_bytes(public_tokenizers.path("piece_bpe_32k.model")), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_prints.fingerprints(table(spark, sf_dir, "documents")).drop("text_sha256")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_licenses, op3_token_files, op4_simhash, op5_warc, op6_secrets, op7_decontamination, op8_url_filters,
    op9_word_bpe, op10_language, op11_alignment, op12_fingerprints, op13_conversations,
)}
