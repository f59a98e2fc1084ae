"""Documents: q18 - q21."""

import uuid

from pyspark.sql import functions as F

from rollcall.functions.text import readable_size
from rollcall.operators import documents as op
from rollcall.operators import reports
from rollcall.operators.small_tables import shared_folder
from rollcall.queries.tables import orders, table, wide_table
from rollcall.sources.document_blocks import block_totals, encode_blocks
from rollcall.sources.documents import read_documents, read_inventory

NAME = """'doc_' || doc_id || CASE lang WHEN 'en' THEN '.md' WHEN 'de' THEN '.MARKDOWN'
  WHEN 'fr' THEN '.txt' ELSE '.pdf' END"""


def _documents(spark, sf_dir):
    return wide_table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "source", "text", f"{NAME} AS file_name"
    )


def q18_doc_encode(spark, sf_dir):
    return op.encode_strings(_documents(spark, sf_dir)).select(
        "doc_id", "file_name",
        op.has_known_suffix(F.col("file_name")).alias("known_suffix"),
        "content_type", "original_size_bytes", "original_size_readable", "encoding",
        F.md5("base64_content").alias("base64_md5"), "base64_size", "original_lines",
    )


def _round_trip(spark, sf_dir):
    """Encode and decode; the transfer loses the last character of one source."""
    encoded = op.encode_strings(_documents(spark, sf_dir)).withColumn(
        "base64_content",
        F.expr("CASE WHEN source = 'src7' THEN left(base64_content, length(base64_content) - 1) "
               "ELSE base64_content END"),
    )
    return op.decode(encoded)


def q19_doc_roundtrip(spark, sf_dir):
    return _round_trip(spark, sf_dir).select(
        "doc_id", "success",
        F.coalesce(F.col("decoded_content") == F.col("text"), F.lit(False)).alias("same"),
        "decoded_size_bytes", "decoded_size_readable", "decoded_lines",
    )


def q19b_batch_summary(spark, sf_dir):
    return reports.batch_summary(_round_trip(spark, sf_dir))


def q20_readable_size(spark, sf_dir):
    sizes = _documents(spark, sf_dir).selectExpr(
        "'doc ' || doc_id AS id", "CAST(octet_length(text) AS BIGINT) AS bytes"
    ).unionByName(
        orders(spark, sf_dir).selectExpr(
            "'order ' || key AS id",
            "CASE status WHEN 'F' THEN CAST(floor(price) AS BIGINT) * 256 WHEN 'O' THEN "
            "CAST(floor(price) AS BIGINT) * CAST(floor(price) AS BIGINT) * 16 ELSE key - key END AS bytes",
        )
    )
    return sizes.select("id", "bytes", readable_size(F.col("bytes")).alias("readable"))


def q21_doc_stats(spark, sf_dir):
    return op.statistics(_documents(spark, sf_dir)).select(
        "doc_id", "file_size", "line_count", "content_preview"
    )


def _files(spark, sf_dir):
    return _documents(spark, sf_dir).selectExpr(
        "source AS family", "file_name", "CAST(octet_length(text) AS BIGINT) AS bytes",
        "doc_id AS modified",
    )


def q21b_inventory(spark, sf_dir):
    return op.inventory_totals(_files(spark, sf_dir), "family")


def q21c_latest_file(spark, sf_dir):
    return op.latest_file(_files(spark, sf_dir), "family")


def _written(spark, sf_dir):
    """The texts of each source as one document file, in order."""
    folder = f"{shared_folder(spark)}/rollcall/{uuid.uuid4().hex}"
    texts = table(spark, sf_dir, "documents").select("source", "doc_id", "text")
    texts.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "text").write.partitionBy("source").text(folder)
    return folder


def q18b_file_encode(spark, sf_dir):
    """Document files written, read back whole and encoded."""
    files = read_documents(spark, f"{_written(spark, sf_dir)}/*")
    return op.encode_files(files).select(
        F.regexp_extract("file_path", "source=([^/]*)", 1).alias("source"), "success", "known_suffix", "file_size_bytes",
        "file_size_readable", "encoding", F.md5("base64_content").alias("base64_md5"), "base64_size", "original_lines",
    )


def q18c_file_blocks(spark, sf_dir):
    """The same files encoded block by block, as for documents too large for one value."""
    encoded = encode_blocks(spark, f"{_written(spark, sf_dir)}/*", block_bytes=4096)
    whole = encoded.groupBy("file_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "base64_content"))), lambda b: b["base64_content"]), "").alias("base64"))
    sizes = block_totals(encoded)
    return sizes.join(whole, "file_path").select(
        F.regexp_extract("file_path", "source=([^/]*)", 1).alias("source"), "file_size_bytes", F.md5("base64").alias("base64_md5"),
        "base64_size", "original_lines",
    )


def q21d_file_inventory(spark, sf_dir):
    """Files and bytes of a written directory, contents unread."""
    return op.inventory_totals(read_inventory(spark, f"{_written(spark, sf_dir)}/*", "*.txt"))


QUERIES = {
    "q18_doc_encode": q18_doc_encode,
    "q18b_file_encode": q18b_file_encode,
    "q18c_file_blocks": q18c_file_blocks,
    "q19_doc_roundtrip": q19_doc_roundtrip,
    "q19b_batch_summary": q19b_batch_summary,
    "q20_readable_size": q20_readable_size,
    "q21_doc_stats": q21_doc_stats,
    "q21b_inventory": q21b_inventory,
    "q21c_latest_file": q21c_latest_file,
    "q21d_file_inventory": q21d_file_inventory,
}


def _size_sql(n):
    return f"""CASE WHEN {n} = 0 THEN '0B' WHEN {n} < 1024 THEN printf('%.1f', {n} / 1.0) || 'B'
      WHEN {n} < 1048576 THEN printf('%.1f', {n} / 1024.0) || 'KB'
      WHEN {n} < 1073741824 THEN printf('%.1f', {n} / 1048576.0) || 'MB'
      ELSE printf('%.1f', CAST({n} AS DOUBLE) / 1073741824.0) || 'GB' END"""


_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
_LINES = f"""len(regexp_extract_all(text, '{_END}'))
  + CASE WHEN text = '' OR regexp_matches(text, '(?:{_END})\\z') THEN 0 ELSE 1 END"""

_DOCS_SQL = f"""
  SELECT doc_id, source, text, {NAME} AS file_name, octet_length(encode(text)) AS bytes,
    {_LINES} AS lines
  FROM documents
"""

# The file of each source, as written, and its text with plain line ends.
_FILES_SQL = f"""
  SELECT source, octet_length(encode(raw)) AS bytes, text, {_LINES} AS lines FROM (
    SELECT source, raw, regexp_replace(raw, '\\r\\n?', chr(10), 'g') AS text FROM (
      SELECT source, string_agg(text || chr(10), '' ORDER BY doc_id) AS raw FROM documents GROUP BY source))
"""

CHECKS = {
    "q18b_file_encode": f"""
      SELECT source, true AS success, true AS known_suffix, bytes AS file_size_bytes, {_size_sql('bytes')} AS file_size_readable,
        'utf-8' AS encoding, md5(to_base64(encode(text))) AS base64_md5, length(to_base64(encode(text))) AS base64_size, lines AS original_lines
      FROM ({_FILES_SQL})
    """,
    "q18c_file_blocks": f"""
      SELECT source, bytes AS file_size_bytes, md5(to_base64(encode(text))) AS base64_md5,
        length(to_base64(encode(text))) AS base64_size, lines AS original_lines
      FROM ({_FILES_SQL})
    """,
    "q21d_file_inventory": f"""
      SELECT count(*) AS files, CAST(sum(bytes) AS BIGINT) AS total_bytes, round(CAST(sum(bytes) AS DOUBLE) / 1048576.0, 4) AS total_mb
      FROM ({_FILES_SQL})
    """,
    "q18_doc_encode": f"""
      SELECT doc_id, file_name, NOT ends_with(file_name, '.pdf') AS known_suffix,
        'string' AS content_type, bytes AS original_size_bytes,
        {_size_sql('bytes')} AS original_size_readable, 'utf-8' AS encoding,
        md5(to_base64(encode(text))) AS base64_md5,
        length(to_base64(encode(text))) AS base64_size, lines AS original_lines
      FROM ({_DOCS_SQL})
    """,
    "q19_doc_roundtrip": f"""
      SELECT doc_id, source != 'src7' AS success, source != 'src7' AS same,
        CASE WHEN source != 'src7' THEN bytes END AS decoded_size_bytes,
        CASE WHEN source != 'src7' THEN {_size_sql('bytes')} END AS decoded_size_readable,
        CASE WHEN source != 'src7' THEN lines END AS decoded_lines
      FROM ({_DOCS_SQL})
    """,
    "q19b_batch_summary": """
      SELECT count(*) AS total_files, count(*) FILTER (WHERE source != 'src7')
        AS successful_conversions, count(*) FILTER (WHERE source = 'src7') AS failed_conversions
      FROM documents
    """,
    "q20_readable_size": f"""
      SELECT id, bytes, {_size_sql('bytes')} AS readable FROM (
        SELECT 'doc ' || doc_id AS id, octet_length(encode(text)) AS bytes FROM documents
        UNION ALL
        SELECT 'order ' || o_orderkey, CASE o_orderstatus
          WHEN 'F' THEN CAST(floor(o_totalprice) AS BIGINT) * 256
          WHEN 'O' THEN CAST(floor(o_totalprice) AS BIGINT) * CAST(floor(o_totalprice) AS BIGINT) * 16
          ELSE 0 END FROM orders)
    """,
    "q21_doc_stats": f"""
      SELECT doc_id, bytes AS file_size, lines AS line_count,
        CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END AS content_preview
      FROM ({_DOCS_SQL})
    """,
    "q21b_inventory": f"""
      SELECT source AS family, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS total_bytes,
        round(CAST(sum(bytes) AS DOUBLE) / 1048576.0, 4) AS total_mb
      FROM ({_DOCS_SQL}) GROUP BY source
    """,
    "q21c_latest_file": f"""
      SELECT source AS family, arg_max(file_name, doc_id) AS file_name
      FROM ({_DOCS_SQL}) GROUP BY source
    """,
}
