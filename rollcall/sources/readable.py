"""Which files can be read to their end.

A compressed file that is cut off or damaged ends a Spark scan, and with it the files
beside it. So compressed files are unpacked once before, each in the task that has its
bytes, and those that fail are named and left out. Nothing but their names and the reason
comes to the driver. Files that are not compressed, or too large for one value (2 GB), are
not looked at.
"""

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNREADABLE = "file string, reason string"
CHUNK = 1 << 20
LARGEST = (1 << 31) - (1 << 20)


def damage(data: bytes) -> str | None:
    """What is wrong with gzip data of any number of members; None if nothing."""
    at, unpack = 0, zlib.decompressobj(31)
    view = memoryview(data)
    try:
        while at < len(view):
            unpack.decompress(view[at : at + CHUNK])
            at += CHUNK
            while unpack.eof and (rest := unpack.unused_data or (view[at : at + CHUNK] if at < len(view) else b"")):
                at += 0 if unpack.unused_data else CHUNK
                unpack = zlib.decompressobj(31)
                unpack.decompress(rest)
    except zlib.error as error:
        return f"damaged: {error}"
    return None if unpack.eof else "cut off within its compressed data"


def unreadable(spark: SparkSession, paths) -> DataFrame:
    """``file`` and ``reason`` of the compressed files among ``paths`` that cannot be unpacked."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(paths)

    def check(batches):
        for batch in batches:
            found = [(f.as_py(), damage(c.as_buffer())) for f, c in zip(*batch.columns)]
            bad = [x for x in found if x[1]]
            yield pa.record_batch([pa.array(x, pa.string()) for x in (list(zip(*bad)) or [(), ()])], names=["file", "reason"])

    return files.filter(F.col("length") < LARGEST).select("path", "content").mapInArrow(check, UNREADABLE)


def readable(spark: SparkSession, paths) -> tuple[list[str] | str, DataFrame]:
    """(the paths, or the files under them without those that cannot be read; those files and why)."""
    if not paths:
        return paths, spark.createDataFrame([], UNREADABLE)
    bad = [tuple(r) for r in unreadable(spark, paths).collect()]  # files that failed
    named = spark.createDataFrame(bad, UNREADABLE)
    if not bad:
        return paths, named
    files = spark.read.format("binaryFile").load(paths).select("path")
    return sorted({r.path for r in files.collect()} - {f for f, _ in bad}), named
