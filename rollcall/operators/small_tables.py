"""Results kept once, and joins that depend on how small a table really is."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
BROADCAST_BYTES = 64 * 1024 * 1024
PIECES = 8  # of a share: hashing deals small pieces more evenly


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a local run may do without."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rollcall-"))
        folder = context.getCheckpointDir()
    return folder


def _own_folder(spark: SparkSession) -> str:
    """Where this application keeps what it computes on the way."""
    return f"{shared_folder(spark)}/rollcall/{spark.sparkContext.applicationId}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_intermediate(spark: SparkSession) -> None:
    """Remove all that :func:`materialise` has written in this application.

    For the caller to do, once the results are written: frames read from these
    tables until then.
    """
    remove(spark, _own_folder(spark))


def materialise(df: DataFrame, **options: str) -> DataFrame:
    """Compute once into a table in the shared folder and read from there.

    ``options`` are those of the Parquet writer.

    The lineage ends at the table: losing executors later costs a re-read, not
    a re-parse. Being Parquet, each reader takes only the columns it needs.
    The tables stay until :func:`drop_intermediate`.
    """
    path = f"{_own_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """A table that grows with the documents, for a join that Spark is not to make a broadcast.

    Spark sizes a table by its files, and what is made of it by the width of a row. Where a
    task makes many rows of one, or repeats are written short, that is far too low, and the
    driver would collect it all.
    """
    return df.hint("merge")


def fits_broadcast(known: DataFrame, max_bytes: int) -> bool:
    """Measure a written table by its rows as text; an empty one fits."""
    size = known.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
    return (size or 0) <= max_bytes


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """``hot`` and ``salts``: the keys with more rows than a partition's share, and over how many to deal them.

    Rows are counted before they are shuffled. A share is the rows divided by the number of
    shuffle partitions, so there are fewer such keys than partitions.
    """
    spark = df.sparkSession
    counts = materialise(df.groupBy(F.col(key).alias("hot")).count())
    share = (counts.agg(F.sum("count")).first()[0] or 0) / int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = F.ceil(F.col("count") * PIECES / F.lit(max(share, 1.0))).cast("int")
    return counts.filter(F.col("hot").isNotNull() & (F.col("count") > share)).select("hot", salts.alias("salts"))


def join_known(
    df: DataFrame, known: DataFrame, key: str, salt_by: str, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Inner join with a written table of one row per key, whatever the skew.

    Up to ``max_bytes`` the table is broadcast and ``df`` stays where it is.
    Beyond that both sides are shuffled, with the rows of hot keys, and of these
    only, dealt over salts in proportion to how many shares they hold.
    """
    if fits_broadcast(known, max_bytes):
        return df.join(F.broadcast(known), key)
    hot = F.broadcast(materialise(hot_keys(df, key)))  # fewer rows than partitions
    dealt = F.coalesce(F.pmod(F.xxhash64(salt_by), F.col("salts")).cast("int"), F.lit(0))
    salted = df.join(hot, F.col(key) == F.col("hot"), "left").withColumn("salt", dealt).drop("hot", "salts")
    each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts") - 1, F.lit(0))))
    copies = known.join(hot, F.col(key) == F.col("hot"), "left").withColumn("salt", each).drop("hot", "salts")
    return salted.join(copies, [key, "salt"]).drop("salt")


def join_small(
    df: DataFrame, small: DataFrame, key: str, salt_by: str, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """:func:`join_known` after computing ``small`` once."""
    return join_known(df, materialise(small), key, salt_by, max_bytes)
