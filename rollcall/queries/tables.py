"""The given tables, and the joins several queries start from."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.sources.spread import spread


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def wide_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table about to be parsed or built up at some cost per row."""
    return spread(table(spark, sf_dir, name))


def with_places(spark: SparkSession, sf_dir: str, df: DataFrame, nation_key: str) -> DataFrame:
    """Add ``nation`` and ``region`` names; Spark sizes the join sides itself."""
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_name", "nation")
    region = table(spark, sf_dir, "region").withColumnRenamed("r_name", "region")
    return df.join(nation, F.col(nation_key) == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_places(spark, sf_dir, wide_table(spark, sf_dir, "customer"), "c_nationkey")
    return df.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("bal"),
        F.col("c_nationkey").alias("nk"), "nation", "region",
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_places(spark, sf_dir, wide_table(spark, sf_dir, "supplier"), "s_nationkey")
    return df.select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("bal"), F.col("s_nationkey").alias("nk"), "nation", "region",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_totalprice").alias("price"),
    )


CUSTOMERS_SQL = """
  SELECT c_custkey AS key, c_name AS name, c_mktsegment AS seg, c_acctbal AS bal,
         c_nationkey AS nk, n_name AS nation, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
"""

SUPPLIERS_SQL = """
  SELECT s_suppkey AS key, s_name AS name, s_acctbal AS bal, s_nationkey AS nk,
         n_name AS nation, r_name AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
"""

ORDERS_SQL = """
  SELECT o_orderkey AS key, o_orderstatus AS status, o_orderpriority AS priority,
         CAST(o_orderdate AS DATE) AS day, o_totalprice AS price
  FROM orders
"""
