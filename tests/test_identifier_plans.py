"""What identity numbers cost a row."""

from pyspark.sql import functions as F

from rollcall.functions import identifiers
from rollcall.operators import markdown


def test_a_number_is_cleaned_once(spark):
    numbers = spark.createDataFrame([("INN", "7707083893")], "kind string, number string")
    for c in (identifiers.identify(F.col("kind"), F.col("number")), identifiers.is_inn(F.col("number")), identifiers.is_imo(F.col("number"))):
        plan = numbers.select(c.alias("c"))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("regexp_replace(") == 2


def test_nulls_and_unknown_kinds(spark):
    rows = [(None, None), ("IMO", None), (None, "7707083893"), (None, "IMO 9074729"), ("Passport", "AB 1"), ("INN", "x")]
    told = spark.createDataFrame(rows, "kind string, number string").select(identifiers.identify(F.col("kind"), F.col("number")).alias("i")).collect()
    assert [tuple(r.i) for r in told] == [
        (None, None, None), ("IMO", None, False), ("INN", "7707083893", True), ("IMO", "IMO 9074729", True), ("Passport", "AB 1", None), ("INN", "x", False)]


def test_identifiers_of_a_row(spark):
    rows = spark.createDataFrame([(1, ["IMO", "Tax no.", "Passport"], ["9074728", "", "P 1"])], "key int, header array<string>, cells array<string>")
    got = markdown.row_identifiers(rows, "key").orderBy("id_no").collect()
    assert [tuple(r) for r in got] == [(1, 0, "IMO", "9074728", False), (1, 1, "Passport", "P 1", None)]
