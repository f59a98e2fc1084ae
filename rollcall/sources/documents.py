"""Document files: contents, inventories, and the encoded output."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.fixed_values import DOCUMENT_SUFFIXES

DOCUMENT_GLOB = "*{" + ",".join(DOCUMENT_SUFFIXES) + "}"


def read_documents(spark: SparkSession, directory: str) -> DataFrame:
    """One row per document of a directory, sub-directories left out."""
    return (
        spark.read.option("pathGlobFilter", DOCUMENT_GLOB).text(directory, wholetext=True)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_size").alias("file_size_bytes"),
            F.col("value").alias("text"),
        )
    )


def read_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Name, bytes and time of every file; contents are pruned from the scan."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
        .select(
            F.regexp_extract("path", r"([^/]*)\z", 1).alias("file_name"),
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified"),
        )
    )


def write_encoded(encoded: DataFrame, directory: str, mode: str = "error") -> DataFrame:
    """Write results to Parquet, then the metadata of the good ones to JSON.

    One table stands for the pair of files per document, so a million
    documents stay a handful of files; each row names the pair it stands for.
    The metadata is read back from the table, so nothing is encoded twice.
    Returns the written results, failures included.
    """
    stem = F.regexp_replace("file_name", r"\.[^.]*\z", "")
    named = encoded.withColumns(
        {
            "base64_file": F.when(F.col("success"), F.concat(stem, F.lit("_base64.txt"))),
            "metadata_file": F.when(F.col("success"), F.concat(stem, F.lit("_metadata.json"))),
        }
    )
    named.write.mode(mode).parquet(f"{directory}/base64")
    written = encoded.sparkSession.read.parquet(f"{directory}/base64")
    written.filter("success").drop("base64_content", "error").write.mode(mode).json(
        f"{directory}/metadata"
    )
    return written
