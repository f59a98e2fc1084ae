"""Plans that matter at scale: what is scanned, parsed and shuffled how often."""

import re

import pytest
from pyspark.sql import functions as F

from rollcall.operators import answers, consolidate, documents, feed, full_list, links, reports
from rollcall.operators.small_tables import hot_keys, join_known, materialise
from rollcall.schemas import FEED_ENTITY, LIST_INDIVIDUAL
from rollcall.sources.xml import parse_column


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path, ddl):
    """An empty Parquet table with many columns, as a scan to plan over."""
    path = str(tmp_path / "t")
    spark.createDataFrame([], ddl).write.parquet(path)
    return spark.read.parquet(path)


def test_feed_is_one_stage_with_one_parse(spark, tmp_path):
    table = stored(spark, tmp_path, "xml string, other string")
    p = plan(feed.flatten_feed(parse_column(table, "xml", FEED_ENTITY, "entity")))
    assert p.count("from_xml(") == 1 and "Exchange" not in p
    assert p.count("jan|feb") == 1  # birth dates are parsed once, for day and year
    assert "ReadSchema: struct<xml:string>" in p


def test_full_list_is_filtered_before_it_is_flattened(spark, tmp_path):
    table = stored(spark, tmp_path, "xml string")
    parsed = parse_column(table, "xml", LIST_INDIVIDUAL, "INDIVIDUAL")
    p = plan(full_list.flatten_individuals(full_list.recent_only(parsed, F.lit("2025-07-30").cast("date"))))
    assert p.count("from_xml(") == 1 and "Exchange" not in p
    assert p.index("array_join") < p.index("Filter") < p.index("Generate")


def test_row_jobs_do_not_shuffle(spark, tmp_path):
    table = stored(spark, tmp_path, "text string, doc string, url string, other string")
    for df in (
        answers.answer_rows(table, "text", "doc"), documents.decode(documents.encode_strings(table)),
        links.best_link(table, "text", "url"), links.page_links(table, "text"),
    ):
        assert "Exchange" not in plan(df)


def test_explode_works_its_array_out_once(spark, tmp_path):
    table = stored(spark, tmp_path, "text string")
    p = plan(links.page_links(table, "text"))
    assert p.count(links.OPEN_ANCHOR) == 1


def test_counts_need_one_column(spark, tmp_path):
    table = stored(spark, tmp_path, "Name string, Type string, Watchlist string, text string")
    assert "ReadSchema: struct<Name:string>" in plan(reports.duplicate_count(table))
    assert "text" not in plan(reports.distribution(table, "Type", "Watchlist"))


@pytest.mark.parametrize("place", ["long", "struct<part:string,row:bigint>"])
def test_first_rows_are_found_among_numbers(spark, tmp_path, place):
    """Only places are aggregated, in hash tables on both sides of the shuffle; texts are picked by a join."""
    table = stored(spark, tmp_path, f"src_rank int, src_file string, row_pos {place}, Source string, Watchlist string, Name string, other string")
    for df in (consolidate.first_rows(table), consolidate.label_files(table), consolidate.consolidate(table)):
        assert "SortAggregate" not in plan(df)
    p = plan(consolidate.first_places(table))
    assert p.count("HashAggregate") == 2 and "Watchlist" not in p


def test_first_rows_with_ties_and_without_places(spark):
    rows = [("a", ("p1", 5), "s1", None), ("a", ("p0", 7), "s2", "w"), ("a", ("p0", 7), "s2", "v"), ("b", None, None, "x"), ("b", None, None, "y"), ("c", ("p", None), "z", "z")]
    table = spark.createDataFrame(rows, "src_file string, row_pos struct<part:string,row:bigint>, Source string, Watchlist string")
    assert sorted(map(tuple, consolidate.first_rows(table).collect())) == [("a", "s2", "v"), ("b", None, "x"), ("c", "z", "z")]


def test_hot_keys_are_dealt_by_weight(spark):
    """A key with a third of the rows gives no task over twice the median; calm keys are not copied."""
    rows = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"), F.col("id").alias("pos"))
    known = materialise(rows.select("k").distinct().withColumn("label", F.concat(F.lit("l "), "k")))
    hot = {r.hot: r.salts for r in hot_keys(rows, "k").collect()}
    assert list(hot) == ["hot"] and hot["hot"] == 22  # a third of the rows, shares of an eighth, eight pieces a share
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = join_known(rows, known, "k", "pos", max_bytes=100)
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert joined.filter("label != concat('l ', k)").count() == 0 and joined.count() == 300_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]



def test_shares_and_total_read_the_same_counts(spark):
    rows = materialise(spark.range(1000).selectExpr("CAST(id % 3 AS STRING) AS Type", "CAST(id % 7 AS STRING) AS Watchlist"))
    for df in (reports.distribution(rows, "Type", "Watchlist"), reports.top_values(rows, "Watchlist")):
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
        scans = len(re.findall(r"FileScan parquet", final))
        assert scans - final.count("ReusedExchange") <= 1 or "ReusedExchange" in final


def test_scalar_totals_are_no_cross_join(spark):
    rows = spark.range(10).selectExpr("CAST(id AS STRING) AS Type", "'x' AS Watchlist")
    p = plan(reports.distribution(rows, "Type", "Watchlist"))
    assert "NestedLoop" not in p and "Cartesian" not in p
