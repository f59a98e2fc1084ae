"""CSV answers in a text column: clean, check, and turn into list rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.fixed_values import FEED_COLUMNS
from rollcall.functions.csvtext import csv_fields, csv_records, fields_at, places_of, present
from rollcall.functions.text import strip_fences
from rollcall.operators.rows import explode_once


def header_fields(answer: Column) -> Column:
    """Number of header fields of a cleaned answer."""
    return F.size(csv_fields(F.get(csv_records(answer), F.lit(0)))).cast("long")


def check_answers(df: DataFrame, answer: str, *keep: str) -> DataFrame:
    """Flag answers whose header has the right number of fields.

    Names are not compared, and a failed check drops nothing.
    """
    fields = F.greatest(header_fields(strip_fences(F.col(answer))), F.lit(0))
    return df.select(*keep, fields.alias("header_fields")).withColumn(
        "valid", F.col("header_fields") == len(FEED_COLUMNS)
    )


def answer_rows(df: DataFrame, answer: str, source: str, *keep: str) -> DataFrame:
    """One row per data record, columns matched by header name.

    ``row_pos`` is the record's place in its answer, ``Source_File`` the
    document the answer is about.
    """
    cleaned = df.select(
        *keep, F.col(source).alias("Source_File"),
        csv_records(strip_fences(F.col(answer))).alias("records"),
    )
    header = csv_fields(F.get("records", F.lit(0)))
    body = F.slice("records", F.lit(2), F.greatest(F.size("records"), F.lit(1)))
    rows = explode_once(
        cleaned, body, "row_pos", "record",
        *keep, "Source_File", places_of(header, FEED_COLUMNS).alias("places"),
    ).withColumn("fields", present(csv_fields(F.col("record"))))
    return rows.select(
        *keep, F.col("row_pos").cast("long").alias("row_pos"),
        *fields_at("fields", "places", FEED_COLUMNS), "Source_File",
    )
