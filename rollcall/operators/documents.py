"""Documents: Base64 with metadata, the way back, statistics, inventories.

One row is one document, so every step is a projection; only the summaries
aggregate.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import fixed_values as fv
from rollcall.functions.text import byte_count, line_count, preview, readable_size

ENCODING = "utf-8"
ALPHABET_ONLY = r"^[A-Za-z0-9+/]*+={0,2}\z"


def to_base64(text: Column) -> Column:
    """One unbroken line, whatever the session says about chunking."""
    return F.replace(F.base64(F.encode(text, "UTF-8")), F.lit("\r\n"), F.lit(""))


def has_known_suffix(file_name: Column) -> Column:
    suffix = F.lower(F.regexp_extract(file_name, r"(\.[^./]*)\z", 1))
    return suffix.isin(*fv.DOCUMENT_SUFFIXES)


def universal_newlines(text: Column) -> Column:
    r"""\r\n and \r as \n, as reading a file in text mode gives."""
    return F.regexp_replace(text, r"\r\n?", "\n")


def encode_strings(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the encoded text and its metadata; sizes are those of the text."""
    size = byte_count(F.col(text))
    return df.withColumns(
        {
            "content_type": F.lit("string"),
            "original_size_bytes": size,
            "original_size_readable": readable_size(size),
            "encoding": F.lit(ENCODING),
            "base64_content": to_base64(F.col(text)),
            "original_lines": line_count(F.col(text)),
        }
    ).withColumn("base64_size", F.length("base64_content").cast("long"))


def encode_files(files: DataFrame) -> DataFrame:
    """Encode files scanned as (file_path, file_name, file_size_bytes, text).

    The size is that of the file, the content that of its text with plain line
    ends. A file that is not UTF-8 keeps its row, with ``success`` false.
    """
    ok = F.is_valid_utf8("text")
    content = F.when(ok, universal_newlines(F.col("text")))
    return (
        files.withColumn("success", ok)
        .withColumn("text", content)
        .select(
            "success",
            F.when(~F.col("success"), F.lit("Encoding error: not valid UTF-8")).alias("error"),
            "file_path",
            "file_name",
            has_known_suffix(F.col("file_name")).alias("known_suffix"),
            "file_size_bytes",
            readable_size(F.col("file_size_bytes")).alias("file_size_readable"),
            F.lit(ENCODING).alias("encoding"),
            to_base64(F.col("text")).alias("base64_content"),
            line_count(F.col("text")).alias("original_lines"),
        )
        .withColumn("base64_size", F.length("base64_content").cast("long"))
    )


def decode(df: DataFrame, encoded: str = "base64_content") -> DataFrame:
    """Add the decoded text; ``success`` is false for bad padding or bad UTF-8.

    Characters outside the alphabet are skipped, as lenient decoders do.
    """
    given = F.col(encoded)
    letters = F.when(given.rlike(ALPHABET_ONLY), given).otherwise(
        F.regexp_replace(given, "[^A-Za-z0-9+/=]+", "")
    )
    raw = F.when(
        F.length("letters") % 4 == 0, F.try_to_binary(F.col("letters"), F.lit("base64"))
    )
    decoded = F.col("decoded_content")
    return (
        df.withColumn("letters", letters)
        .withColumn("decoded_content", F.try_validate_utf8(raw.cast("string")))
        .drop("letters")
        .withColumns(
            {
                "success": decoded.isNotNull(),
                "decoded_size_bytes": byte_count(decoded),
                "decoded_size_readable": readable_size(byte_count(decoded)),
                "decoded_lines": line_count(decoded),
            }
        )
    )


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumns(
        {
            "file_size": byte_count(F.col(text)),
            "line_count": line_count(F.col(text)),
            "content_preview": preview(F.col(text)),
        }
    )


def inventory_totals(files: DataFrame, *by: str) -> DataFrame:
    """Files, bytes and megabytes, over all files or per group."""
    size = F.sum("bytes")
    return files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"),
        size.alias("total_bytes"),
        F.round(size / (1024.0 * 1024.0), 4).alias("total_mb"),
    )


def latest_file(files: DataFrame, *by: str) -> DataFrame:
    """The newest file of each family; the name settles equal times."""
    newest = F.max(F.struct("modified", "file_name"))
    return files.groupBy(*by).agg(newest.alias("newest")).select(
        *by, F.col("newest.file_name").alias("file_name")
    )
