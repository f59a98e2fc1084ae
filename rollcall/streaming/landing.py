"""Feed files landed continuously instead of run by run.

The transforms are the batch ones: each is a projection of single records, so
a stream needs no state, no watermark and no shuffle. Deduplication is left to
the consolidation job, which reads what landed here; a stream has no file
order for "first" to mean anything.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rollcall.operators import feed
from rollcall.operators.small_tables import CHECKPOINT_DIR
from rollcall.schemas import FEED_ENTITY, XML_OPTIONS


def feed_stream(spark: SparkSession, directory: str, files_per_batch: int = 1000) -> DataFrame:
    """Flat records of every delta-feed file that appears in a directory."""
    entities = (
        spark.readStream.schema(FEED_ENTITY).options(**XML_OPTIONS)
        .option("rowTag", "entity").option("maxFilesPerTrigger", files_per_batch)
        .xml(directory)
    )
    return feed.flatten_feed(entities)


def land(stream: DataFrame, out_dir: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet table, taking up all files now present.

    Progress is kept in ``checkpoint``, by default beside the session's own
    checkpoints, so a lost driver or executor repeats no file and skips none.
    """
    if checkpoint is None:
        root = stream.sparkSession.conf.get(CHECKPOINT_DIR)
        checkpoint = f"{root}/landing/{out_dir.strip('/').replace('/', '_')}"
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", out_dir)
        .trigger(availableNow=True).start()
    )
