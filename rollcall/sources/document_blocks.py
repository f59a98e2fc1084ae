"""Documents too large for one value: encoded block by block.

The text source reads a file's lines in many tasks. Lines are gathered into blocks of
bounded size within their piece of the file, with plain line ends, and each block is
encoded on its own. Base64 takes three bytes at a time, so a block encodes the triples
that begin in it: it leaves out its first bytes that end the block before, and borrows
up to two bytes from the blocks behind. Joined in order, the blocks give what encoding
the whole text gives; sizes and lines add up.

Lines are shuffled once, by piece of the file; the borrowing is worked out on a table of a
few numbers per block. A line must fit one value. A file without a byte has no block.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.functions.text import line_count, readable_size
from rollcall.operators.documents import ENCODING, has_known_suffix
from rollcall.operators.small_tables import join_known, materialise
from rollcall.sources.documents import DOCUMENT_GLOB

BLOCK_BYTES = 8 << 20
FILE = ("file_path", "file_name", "file_size_bytes")


def _lines(spark: SparkSession, directory: str) -> DataFrame:
    """Every line with its file, its piece of it and its place there."""
    lines = spark.read.option("pathGlobFilter", DOCUMENT_GLOB).option("lineSep", "\n").text(directory)
    return lines.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size_bytes"), F.col("_metadata.file_block_start").alias("piece"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def _blocks(spark: SparkSession, directory: str, block_bytes: int) -> DataFrame:
    """Blocks of whole lines: raw size, whether it is UTF-8, and its text, which still lacks the file's last line end if there is none."""
    order = W.partitionBy("file_path", "piece").orderBy("at")
    size = F.octet_length("line").cast("long") + 1
    before = F.coalesce(F.sum(size).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    numbered = _lines(spark, directory).withColumn("no", F.floor(before / block_bytes).cast("long"))
    # A carriage return ahead of the line end goes, any other is a line end.
    plain = F.replace(F.regexp_replace("line", r"\r\z", ""), F.lit("\r"), F.lit("\n"))
    held = F.array_sort(F.collect_list(F.struct("at", plain.alias("plain"))))
    return numbered.groupBy(*FILE, "piece", "no").agg(
        F.sum(size).alias("raw"), F.bool_and(F.is_valid_utf8("line")).alias("valid"), F.max(F.struct("at", F.col("line").endswith("\r").alias("cr"))).alias("end"),
        F.array_join(F.transform(held, lambda x: x["plain"]), "\n").alias("text"))


def encode_blocks(spark: SparkSession, directory: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of every document: the file, ``block`` (its first byte's place in the text), ``success`` and ``base64_content``.

    ``success`` is that of the file. Blocks of files that are not UTF-8 have no content.
    """
    blocks = materialise(_blocks(spark, directory, block_bytes))
    of_file, order = W.partitionBy("file_path"), W.partitionBy("file_path").orderBy("piece", "no")  # a few numbers per block
    last = F.lead("no").over(order).isNull()
    # A line end is counted for every line, so a file of one byte less lacks its last one.
    ended = ~last | (F.sum("raw").over(of_file) == F.col("file_size_bytes"))
    tail = F.when(ended | F.col("end.cr"), "\n").otherwise("")
    narrow = blocks.select(*FILE, "piece", "no", "raw", "valid", "end", F.octet_length("text").cast("long").alias("size"), F.substring(F.encode(F.substring("text", 1, 2), "UTF-8"), 1, 2).alias("head"))
    narrow = narrow.withColumn("tail", tail).withColumn("size", F.col("size") + F.length("tail"))
    narrow = narrow.withColumn("head", F.substring(F.concat("head", F.encode("tail", "UTF-8")), 1, 2))
    start = F.coalesce(F.sum("size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    none = F.lit(b"")
    behind = F.concat(F.coalesce(F.lead("head", 1).over(order), none), F.coalesce(F.lead("head", 2).over(order), none))
    known = narrow.withColumns({"block": start, "behind": behind, "success": F.bool_and("valid").over(of_file)})
    lent, borrowed = F.pmod(-F.col("block"), F.lit(3)).cast("int"), F.pmod(-(F.col("block") + F.col("size")), F.lit(3)).cast("int")
    known = known.select(F.struct("file_path", "piece", "no").alias("place"), "tail", "block", "size", "success", lent.alias("lent"), F.expr("substring(behind, 1, 2)").alias("behind"), borrowed.alias("borrowed"))
    joined = join_known(blocks.withColumn("place", F.struct("file_path", "piece", "no")).drop("file_size"), materialise(known), "place", "no")
    data = F.concat(F.encode(F.concat("text", "tail"), "UTF-8"), F.substring(F.col("behind"), F.lit(1), F.col("borrowed")))
    content = F.replace(F.base64(F.substring(data, F.col("lent") + 1, F.length(data))), F.lit("\r\n"), F.lit(""))
    own = F.when(F.col("size") > F.col("lent"), content).otherwise("")
    return joined.select(*FILE, "block", "success", F.when(F.col("success"), own).alias("base64_content"), F.when(F.col("success"), line_count(F.concat("text", "tail"))).alias("lines"))


def block_totals(encoded: DataFrame) -> DataFrame:
    """One row per document, as of :func:`rollcall.operators.documents.encode_files`, without the content."""
    totals = encoded.groupBy(*FILE).agg(
        F.bool_and("success").alias("success"), F.count("*").alias("blocks"), F.sum("lines").alias("original_lines"),
        F.sum(F.length("base64_content").cast("long")).alias("base64_size"))
    return totals.withColumns({
        "known_suffix": has_known_suffix(F.col("file_name")), "file_size_readable": readable_size(F.col("file_size_bytes")), "encoding": F.lit(ENCODING)})
