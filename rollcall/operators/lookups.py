"""Code dictionaries as dimension tables."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def code_table(df: DataFrame, table: Mapping[str, str], code: str, label: str) -> DataFrame:
    """A fixed dictionary as rows; its size is that of the source text."""
    entries = [f"named_struct('k', '{k}', 'v', '{v}')" for k, v in table.items()]
    one = df.sparkSession.sql(f"SELECT inline(array({', '.join(entries)}))")
    return one.select(F.col("k").alias(code), F.col("v").alias(label))


def decode_by_join(
    df: DataFrame, code: str, table: Mapping[str, str], miss_prefix: str, label: str
) -> DataFrame:
    """Decode a code column by a left join; a miss keeps the code, named.

    The hint is safe: the dimension is a constant of a dozen rows.
    """
    known = code_table(df, table, code, "known")
    missed = F.concat(F.lit(miss_prefix), F.coalesce(F.col(code), F.lit("None")))
    return (
        df.join(F.broadcast(known), code, "left")
        .withColumn(label, F.coalesce("known", missed))
        .drop("known")
    )
