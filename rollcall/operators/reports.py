"""Counts, shares and totals over flat records.

Group keys here may be as many as the values of a column, so nothing ranks or
totals them in one task: totals come from a scalar subquery over the grouped
counts, and top lists from a distributed top-k.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import fixed_values as fv
from rollcall.functions import labels


def _long(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(column, value), one row per input row and column, from a single scan."""
    return df.select(*columns).unpivot([], list(columns), "column", "value")


def _counts(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return _long(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _present(counted: DataFrame) -> DataFrame:
    """Counts of real values only.

    The test also names the count, or it would be pushed below the grouping
    and make a second scan out of two readings of the same counts.
    """
    return counted.filter(F.col("value").isNotNull() | (F.col("n") < 0))


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value, missing values left out, most frequent first."""
    long = _long(df, columns).filter(F.col("value").isNotNull())
    counted = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy("column", F.desc("n"), "value")


def distribution(df: DataFrame, *columns: str) -> DataFrame:
    """Value counts with their share of *all* rows, missing ones included."""
    counted = _counts(df, columns)
    rows = counted.agg(F.sum("n") / len(columns)).scalar()
    return _present(counted).select(
        "column", "value", "n", (F.col("n") / rows * 100).alias("pct")
    )


def top_values(df: DataFrame, column: str, k: int = fv.TOP_VALUES) -> DataFrame:
    """The k most frequent values, then one row counting the other values."""
    counted = (
        df.select(F.col(column).alias("value")).filter(F.col("value").isNotNull())
        .groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    )
    top = counted.orderBy(F.desc("n"), "value").limit(k)
    others = counted.agg((F.count_if(F.col("n") > 0) - k).alias("n")).filter(F.col("n") > 0)
    return top.select(F.lit("value").alias("kind"), "value", "n").unionByName(
        others.select(F.lit("other values").alias("kind"), F.lit(None).cast("string").alias("value"), "n")
    )


def type_metrics(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("Type") == "Individual").alias("individuals"),
        F.count_if(F.col("Type") == "Entity").alias("entities"),
    )


def rows_by_class(df: DataFrame, file_name: Column) -> DataFrame:
    """Rows per file class; all four classes are always reported."""
    kind = labels.file_class(file_name)
    return df.agg(
        *[F.count_if(kind == k).alias(f"{k}_records") for k in ("pdf", "ofac", "un", "other")]
    )


def rows_by_source(df: DataFrame, source: str = "Source_File") -> DataFrame:
    return df.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"))


def duplicate_count(df: DataFrame, key: str = "Name") -> DataFrame:
    """Rows a keep-first dedupe drops; all missing keys count as one."""
    missing = F.max(F.col(key).isNull().cast("int"))
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        (F.count(F.lit(1)) - F.countDistinct(key) - F.coalesce(missing, F.lit(0))).alias("duplicates"),
    )


def report_sheet(kept: DataFrame, duplicates: DataFrame, files: Column) -> DataFrame:
    """The four-row summary that goes next to a consolidated table.

    ``duplicates`` is what :func:`duplicate_count` gave for the rows before the
    dedupe, ``files`` the number of input files.
    """
    sources = kept.agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("Source_File").alias("sources")
    )
    dropped = duplicates.select("duplicates").scalar()
    return sources.select(
        F.inline(
            F.array(
                F.struct(F.lit("Total Records").alias("Metric"), F.col("records").alias("Value")),
                F.struct(F.lit("Files Processed").alias("Metric"), files.cast("long").alias("Value")),
                F.struct(F.lit("Duplicates Removed").alias("Metric"), dropped.alias("Value")),
                F.struct(F.lit("Data Sources").alias("Metric"), F.col("sources").alias("Value")),
            )
        )
    )


def summary_record(before: DataFrame, kept: DataFrame, file_name: str = "src_file") -> DataFrame:
    """Everything a run reports, long: (metric, item, n).

    ``before`` are the labelled rows ahead of the dedupe, ``kept`` those after
    it. Both are read several times, so pass tables that have been written.
    """
    item = F.lit(None).cast("string").alias("item")
    dup = duplicate_count(before)
    total = kept.agg(F.count(F.lit(1)).alias("n")).select(F.lit("total_records").alias("metric"), item, "n")
    dropped = dup.select(F.lit("duplicate_removed").alias("metric"), item, F.col("duplicates").alias("n"))
    classes = rows_by_class(before, F.col(file_name)).unpivot(
        [], ["pdf_records", "ofac_records", "un_records", "other_records"], "item", "n"
    ).select(F.lit("processing_breakdown").alias("metric"), "item", "n")
    shares = _counts(kept, ("Watchlist", "Type")).filter(F.col("value").isNotNull()).select(
        F.concat(F.lower("column"), F.lit("_distribution")).alias("metric"),
        F.col("value").alias("item"), "n",
    )
    return total.unionByName(dropped).unionByName(classes).unionByName(shares)


def run_totals(log: DataFrame) -> DataFrame:
    """One row over a run log (success, records, seconds, elapsed per file)."""
    ok = F.count_if("success")
    seconds, records = F.sum("seconds"), F.sum("records")
    return log.agg(
        F.count(F.lit(1)).alias("files"),
        ok.alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(records, F.lit(0)).alias("records"),
        F.round(F.coalesce(seconds, F.lit(0.0)), 4).alias("seconds"),
        F.round(seconds / F.nullif(ok, F.lit(0)), 4).alias("seconds_per_file"),
        F.round(records / F.nullif(ok, F.lit(0)), 4).alias("records_per_file"),
        F.round(F.count(F.lit(1)) * 60 / F.nullif(F.sum("elapsed"), F.lit(0.0)), 4)
        .alias("files_per_minute"),
    )


def error_kinds(log: DataFrame) -> DataFrame:
    """Failed runs by whether a retry may help."""
    failed = log.filter(~F.col("success"))
    return failed.groupBy("error", labels.is_transient(F.col("error")).alias("transient")).agg(
        F.count(F.lit(1)).alias("n")
    )


def batch_summary(results: DataFrame) -> DataFrame:
    """Totals of a conversion batch with a boolean ``success`` column."""
    return results.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if("success").alias("successful_conversions"),
        F.count_if(~F.col("success")).alias("failed_conversions"),
    )
