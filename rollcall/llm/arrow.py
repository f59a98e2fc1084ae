"""Settings of the exchange with Python for the time of one job."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run within send that many rows to Python at once: texts can be long, and a batch is held by both sides."""
    before = spark.conf.get(ROWS, None)
    spark.conf.set(ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(ROWS) if before is None else spark.conf.set(ROWS, before)
