"""Spreading small inputs over the cores."""

from pyspark.sql import DataFrame


def spread(scan: DataFrame) -> DataFrame:
    """Deal out a scan that comes in fewer pieces than there are cores.

    A single small file is one task, however costly the parse that follows.
    A scan with enough pieces, as any large one has, is returned untouched, so
    the extra shuffle never carries more than a few file blocks per core.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
