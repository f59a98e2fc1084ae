"""Reports over consolidated rows and run logs: q34 - q37."""

from pyspark.sql import functions as F

from rollcall import fixed_values as fv
from rollcall.operators import consolidate as op
from rollcall.operators import reports
from rollcall.operators.small_tables import materialise
from rollcall.queries.consolidation import (
    CONSOLIDATED_SQL, FEED_FILE, LIST_FILE, _first_sql, _parties, _union_sql,
)
from rollcall.queries.tables import table


def q34_distribution_pct(spark, sf_dir):
    """Shares of the consolidated table; it is computed once, then counted."""
    kept = materialise(op.consolidate(_parties(spark, sf_dir), ordered=False).select("Type", "Watchlist"))
    return reports.distribution(kept, "Type", "Watchlist")


def q35_rows_by_class(spark, sf_dir):
    return reports.rows_by_class(_parties(spark, sf_dir), F.col("src_file"))


def _tagged(spark, sf_dir):
    """All rows in the interactive order, under the source tags it shows."""
    tag = (
        F.when(F.col("src_file") == FEED_FILE, F.lit(fv.FEED_SOURCE_TAG))
        .when(F.col("src_file") == LIST_FILE, F.lit(fv.LIST_SOURCE_TAG))
        .otherwise(F.col("src_file"))
    )
    return _parties(spark, sf_dir, 1, 2, 0).withColumn("Source_File", tag)


def q36_source_summary(spark, sf_dir):
    """The summary sheet beside the interactive job's table."""
    rows = materialise(_tagged(spark, sf_dir).select("Name", "src_rank", "src_file", "row_pos", "Source_File"))
    uploads = rows.filter(F.col("src_rank") == 0).agg(F.countDistinct("src_file")).scalar()
    kept = op.consolidate(rows, normalised=False)
    return reports.report_sheet(kept, reports.duplicate_count(rows), uploads)


def q36b_rows_by_source(spark, sf_dir):
    return reports.rows_by_source(op.consolidate(_tagged(spark, sf_dir), normalised=False))


def q36c_summary_record(spark, sf_dir):
    rows = materialise(_parties(spark, sf_dir))
    kept = materialise(op.consolidate(rows, ordered=False).select("Type", "Watchlist"))
    return reports.summary_record(rows, kept)


def _log(spark, sf_dir):
    """Events as runs: an error event is a failed run, its user the message."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type != 'error' AS success",
        "CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) END AS records",
        "CASE WHEN event_type = 'purchase' THEN value END AS seconds",
        "value AS elapsed",
        """CASE WHEN event_type = 'error' THEN CASE WHEN value < 10 THEN '429 Too Many Requests'
           WHEN value < 20 THEN 'Quota Exceeded for user ' || user_id WHEN value < 40
           THEN 'Invalid argument ' || user_id ELSE 'The model is OVERLOADED' END END AS error""",
    )


def q37_run_log(spark, sf_dir):
    return reports.run_totals(_log(spark, sf_dir))


def q37b_error_kinds(spark, sf_dir):
    return reports.error_kinds(_log(spark, sf_dir))


QUERIES = {
    "q34_distribution_pct": q34_distribution_pct,
    "q35_rows_by_class": q35_rows_by_class,
    "q36_source_summary": q36_source_summary,
    "q36b_rows_by_source": q36b_rows_by_source,
    "q36c_summary_record": q36c_summary_record,
    "q37_run_log": q37_run_log,
    "q37b_error_kinds": q37b_error_kinds,
}

_KEPT = _first_sql(CONSOLIDATED_SQL)
_KEPT_APP = _first_sql(_union_sql(1, 2, 0))


def _share(column):
    return f"""SELECT '{column}' AS "column", {column} AS value, count(*) AS n,
      count(*) / CAST((SELECT count(*) FROM kept) AS DOUBLE) * 100 AS pct
      FROM kept WHERE {column} IS NOT NULL GROUP BY {column}"""


_TAG = f"""CASE WHEN src_file = '{FEED_FILE}' THEN 'OFAC_API' WHEN src_file = '{LIST_FILE}'
  THEN 'UN_API' ELSE src_file END"""

_DUPLICATES = """(SELECT count(*) - count(DISTINCT Name) -
  CASE WHEN count(*) > count(Name) THEN 1 ELSE 0 END FROM u)"""

_CLASSES = """
  count(*) FILTER (WHERE src_file LIKE 'sanctions_from_%') AS pdf_records,
  CAST(0 AS BIGINT) AS ofac_records,
  count(*) FILTER (WHERE src_file LIKE 'sanctions_cleaned_un_%') AS un_records,
  count(*) FILTER (WHERE src_file LIKE 'sanctions_cleaned_2%') AS other_records
"""

CHECKS = {
    "q34_distribution_pct": f"WITH kept AS ({_KEPT}) {_share('Type')} UNION ALL {_share('Watchlist')}",
    "q35_rows_by_class": f"SELECT {_CLASSES} FROM ({_union_sql()})",
    "q36_source_summary": f"""
      WITH u AS ({_union_sql(1, 2, 0)}), kept AS ({_KEPT_APP})
      SELECT 'Total Records' AS "Metric", count(*) AS "Value" FROM kept
      UNION ALL SELECT 'Files Processed', count(DISTINCT src_file) FROM u WHERE src_rank = 0
      UNION ALL SELECT 'Duplicates Removed', {_DUPLICATES}
      UNION ALL SELECT 'Data Sources', count(DISTINCT src_file) FROM kept
    """,
    "q36b_rows_by_source": f"SELECT {_TAG} AS source, count(*) AS n FROM ({_KEPT_APP}) GROUP BY 1",
    "q36c_summary_record": f"""
      WITH u AS ({_union_sql()}), kept AS ({_KEPT}), c AS (SELECT {_CLASSES} FROM u)
      SELECT 'total_records' AS metric, CAST(NULL AS VARCHAR) AS item, count(*) AS n FROM kept
      UNION ALL SELECT 'duplicate_removed', NULL, {_DUPLICATES}
      UNION ALL SELECT 'processing_breakdown', 'pdf_records', pdf_records FROM c
      UNION ALL SELECT 'processing_breakdown', 'ofac_records', ofac_records FROM c
      UNION ALL SELECT 'processing_breakdown', 'un_records', un_records FROM c
      UNION ALL SELECT 'processing_breakdown', 'other_records', other_records FROM c
      UNION ALL SELECT 'watchlist_distribution', Watchlist, count(*) FROM kept
        WHERE Watchlist IS NOT NULL GROUP BY Watchlist
      UNION ALL SELECT 'type_distribution', Type, count(*) FROM kept
        WHERE Type IS NOT NULL GROUP BY Type
    """,
    "q37_run_log": """
      SELECT count(*) AS files, count(*) FILTER (WHERE event_type != 'error') AS succeeded,
        count(*) FILTER (WHERE event_type = 'error') AS failed,
        CAST(sum(floor(value)) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS records,
        round(sum(value) FILTER (WHERE event_type = 'purchase'), 4) AS seconds,
        round(sum(value) FILTER (WHERE event_type = 'purchase')
          / count(*) FILTER (WHERE event_type != 'error'), 4) AS seconds_per_file,
        round(sum(floor(value)) FILTER (WHERE event_type = 'purchase')
          / count(*) FILTER (WHERE event_type != 'error'), 4) AS records_per_file,
        round(count(*) * 60 / sum(value), 4) AS files_per_minute
      FROM events
    """,
    "q37b_error_kinds": """
      WITH e AS (SELECT CASE WHEN value < 10 THEN '429 Too Many Requests'
          WHEN value < 20 THEN 'Quota Exceeded for user ' || user_id
          WHEN value < 40 THEN 'Invalid argument ' || user_id ELSE 'The model is OVERLOADED' END AS error
        FROM events WHERE event_type = 'error')
      SELECT error, regexp_matches(error, '(?i)429|quota|overloaded|500|503') AS transient, count(*) AS n
      FROM e GROUP BY error
    """,
}
