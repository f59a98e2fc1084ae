"""Connected components of a graph of any size, by alternating stars.

The smallest neighbours are written before they are joined back to the edges: a join of two
shuffled sides can be split by Spark where one node has a large share of all edges, while one
with an aggregate on its other side can not.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.small_tables import materialise, shuffled


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m")))
    return both.filter("b > a").join(shuffled(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them; ``a`` > ``b`` in all edges of the written table."""
    least = materialise(edges.groupBy("a").agg(F.min("b").alias("m")))
    tied = edges.join(shuffled(least), "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node with an edge.

    ``edges`` has columns ``a`` and ``b``, in any direction and with any repeats. Each
    round is written to the shared folder, so lost executors cost a re-read; only a
    count and a checksum come to the driver. The rounds needed grow with the logarithm
    of the longest chain.
    """
    now = materialise(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(now)
    while state[0]:
        after = materialise(_small_star(materialise(_large_star(now))))
        now, before, state = after, state, _state(after)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
