"""Arrays to rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_once(df: DataFrame, items: Column, pos: str, item: str, *keep) -> DataFrame:
    """One row per array entry, with its place; empty arrays give none.

    The array and all ``keep`` columns are worked out ahead of the explode, so
    no entry carries the whole array along or repeats a per-record step. A
    plain explode also lets the optimizer infer a filter on the array's size,
    which works the array out a second time, below any repartitioning; the
    outer form does not, and its empty rows go by their missing place.
    """
    ready = df.select(*keep, items.alias("exploding"))
    kept = [c for c in ready.columns if c != "exploding"]
    rows = ready.select(*kept, F.posexplode_outer("exploding").alias(pos, item))
    return rows.filter(F.col(pos).isNotNull())
