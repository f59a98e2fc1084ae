"""Normalising and consolidating: q25 - q33."""

import uuid

from pyspark.sql import functions as F

from rollcall.functions import dates, labels
from rollcall.functions.csvtext import csv_fields, csv_records, fields_at, places_of, present
from rollcall.operators import consolidate as op
from rollcall.operators import reports
from rollcall.operators.rows import explode_once
from rollcall.operators.small_tables import shared_folder
from rollcall.queries.tables import (
    CUSTOMERS_SQL, ORDERS_SQL, SUPPLIERS_SQL, customers, orders, suppliers, table, wide_table,
)
from rollcall.sources import list_csv

# -- dates and labels -------------------------------------------------------

WRITTEN = """CASE WHEN status = 'P' AND price < 100000 THEN '  ' WHEN status = 'P' AND price < 200000
    THEN date_format(day, 'dd/MM/yy') WHEN status = 'P' AND price < 300000
    THEN '31/02/' || year(day) WHEN status = 'P' THEN date_format(day, 'd MMM yyyy') || ' (approx)'
  WHEN priority = '1-URGENT' THEN date_format(day, 'd/M/yyyy')
  WHEN priority = '2-HIGH' THEN CASE WHEN price < 150000 THEN date_format(day, 'dd-MM-yyyy')
    ELSE date_format(day, 'dd.MM.yyyy') END
  WHEN priority = '3-MEDIUM' THEN CASE WHEN price < 150000 THEN date_format(day, ' yyyy-M-d ')
    ELSE date_format(day, 'yyyy/MM/dd') END
  WHEN priority = '4-NOT SPECIFIED' THEN date_format(day, 'MM/dd/yyyy')
  WHEN price < 150000 THEN date_format(day, 'dd  M yyyy') END"""


def _dated(spark, sf_dir):
    return orders(spark, sf_dir).selectExpr("key", f"{WRITTEN} AS DOB_DJ")


def q25_date_standardise(spark, sf_dir):
    return _dated(spark, sf_dir).select("key", dates.standardise_date(F.col("DOB_DJ")).alias("DOB_DJ"))


def q26_date_converted_count(spark, sf_dir):
    return op.converted_dates(op.normalise(_dated(spark, sf_dir)))


NUMBER = """CASE priority WHEN '1-URGENT' THEN year(day) || lpad(CAST(key AS STRING), 12, '0')
  WHEN '2-HIGH' THEN CAST(key AS STRING) WHEN '3-MEDIUM' THEN year(day) || '0000'
  WHEN '4-NOT SPECIFIED' THEN year(day) || 'a' || key END"""


def q29_regulation_number(spark, sf_dir):
    numbered = orders(spark, sf_dir).selectExpr("key", f"{NUMBER} AS number")
    return numbered.select("key", "number", labels.regulation_label(F.col("number")).alias("label"))


RAW_LABEL = """CASE WHEN seg = 'HOUSEHOLD' THEN CASE WHEN bal < 2000 THEN NULL WHEN bal < 4000 THEN ''
    WHEN bal < 6000 THEN 'Unknown' ELSE ' ' || nation END
  WHEN seg = 'MACHINERY' THEN CASE WHEN bal < 3000 THEN 'OFAC - ' || nation WHEN bal < 6000
    THEN 'US Treasury' ELSE 'specially Designated' END
  WHEN seg = 'BUILDING' THEN CASE WHEN bal < 3000 THEN ' 2025/' || key || ' ' WHEN bal < 6000
    THEN 'Council Decision 2024/1' ELSE 'No 2024/' || nk || ' annex' END
  WHEN seg = 'AUTOMOBILE' THEN CASE WHEN bal < 5000 THEN 'Museum' ELSE 'eu list' END
  ELSE region || ' list ' || nk END"""


def _labelled(spark, sf_dir):
    return customers(spark, sf_dir).selectExpr("key", f"{RAW_LABEL} AS Watchlist")


def q30_watchlist_standardise(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    return rows.select(
        "key", labels.standard_watchlist(F.col("Watchlist")).alias("watchlist"),
        labels.standard_watchlist(F.col("Watchlist"), strict=True).alias("strict_watchlist"),
    )


def q30b_watchlist_top10(spark, sf_dir):
    """Most frequent labels before and after standardising."""
    rows = _labelled(spark, sf_dir)
    before = reports.top_values(rows, "Watchlist").withColumn("stage", F.lit("before"))
    after = reports.top_values(op.normalise(rows), "Watchlist").withColumn("stage", F.lit("after"))
    return before.unionByName(after)


# -- files --------------------------------------------------------------------

CSV_FILE = """CASE WHEN p_type = 'PROMO' THEN 'Name,Watchlist\\n' WHEN p_type = 'LARGE' THEN ''
  ELSE 'Type,Name,DOB_DJ\\nEntity,"' || p_name || ', ' || p_brand || '",' || CASE
    WHEN p_size < 15 THEN 'NaN' WHEN p_size < 30 THEN '<NA>' ELSE '1958' END
    || '\\n,null,"-1.#IND"\\nnone,N/A ,n/a\\n' END"""


def q27_csv_union_scan(spark, sf_dir):
    """CSV texts of three shapes: with rows, header only, and empty."""
    files = wide_table(spark, sf_dir, "part").selectExpr("p_partkey AS key", f"{CSV_FILE} AS text")
    parsed = files.select("key", csv_records(F.col("text")).alias("records"))
    names = ("Name", "Type", "DOB_DJ", "Watchlist")
    places = places_of(csv_fields(F.get("records", F.lit(0))), names)
    body = F.slice("records", F.lit(2), F.greatest(F.size("records"), F.lit(1)))
    rows = explode_once(parsed, body, "row_pos", "record", "key", places.alias("places"))
    fields = present(csv_fields(F.col("record")))
    return rows.withColumn("fields", fields).select(
        "key", "row_pos", *fields_at("fields", "places", names)
    )


# Exports of parts, whose columns differ in number, order and name.
PART_EXPORTS = {
    "sanctions_cleaned_promo.csv": ("p_type = 'PROMO'", "p_partkey AS key",
        """p_name || ', "' || p_brand || '",\n' || p_size AS Name""", "'a, b' AS Watchlist"),
    "sanctions_cleaned_large.csv": ("p_type = 'LARGE'", "'Entity' AS Type", "p_size AS Extra",
        "CASE WHEN p_size < 15 THEN 'NaN' WHEN p_size < 30 THEN '' ELSE '1958' END AS DOB_DJ",
        "p_brand AS Name", "p_partkey AS key"),
    "sanctions_from_2025_t.csv": ("p_type NOT IN ('PROMO', 'LARGE')", "CASE WHEN p_size > 9 THEN p_name END AS Name",
        "p_partkey AS key"),
    "sanctions_from_none_t.csv": ("p_size < 0", "p_name AS Name"),
}


def q27b_csv_files(spark, sf_dir):
    """CSV files of differing columns, written and then read by one scan."""
    folder = f"{shared_folder(spark)}/rollcall/{uuid.uuid4().hex}"
    part = table(spark, sf_dir, "part")
    for name, (chosen, *columns) in PART_EXPORTS.items():
        list_csv.write_list_csv(part.filter(chosen).selectExpr(*columns), f"{folder}/{name}")
    names = ("key", "Name", "Type", "DOB_DJ", "Watchlist")
    rows = list_csv.read_list_csv(spark, list_csv.list_exports(spark, folder), names)
    return rows.withColumn("key", F.col("key").cast("long")).select(*names, "src_rank", "src_file")


# Orders with line breaks, commas and quotes inside their fields.
ORDER_NAME = """CASE status WHEN 'P' THEN 'one line' WHEN 'F' THEN '"' || priority || '",\n\n' || key
  ELSE '\n' || key || '\n"' END"""


def q27c_csv_blocks(spark, sf_dir):
    """A large export with line breaks in its fields, written and then read in blocks."""
    folder = f"{shared_folder(spark)}/rollcall/{uuid.uuid4().hex}"
    rows = orders(spark, sf_dir).selectExpr("key", f"{ORDER_NAME} AS Name", "date_format(day, 'yyyy') AS DOB_DJ", "'a\nb' AS Watchlist")
    list_csv.write_list_csv(rows, f"{folder}/sanctions_cleaned_orders.csv")
    read = list_csv.read_list_csv(spark, list_csv.list_exports(spark, folder), ("key", "Name", "DOB_DJ", "Watchlist"), splittable=True)
    return read.select(F.col("key").cast("long").alias("key"), "Name", "DOB_DJ", "Watchlist", "src_file")


FILE_COLUMNS = (
    "doc_id AS row_pos",
    """CASE WHEN length(source) = 4 THEN 'sanctions_cleaned_' || source || '.csv'
      WHEN source = 'src10' THEN 'sanctions_from_abc_t.csv'
      ELSE 'sanctions_from_2025' || lpad(substr(source, 4), 5, '0') || '_t.csv' END AS src_file""",
    "CASE WHEN n_chars > 3000 THEN 'UN Security Council' WHEN lang = 'de' THEN 'Ministry' END AS Source",
    """CASE lang WHEN 'de' THEN 'OFAC - Specially Designated National List'
      WHEN 'fr' THEN '2024/9' END AS Watchlist""",
)


def _file_rows(spark, sf_dir):
    """The documents of one source as the rows of one file."""
    return wide_table(spark, sf_dir, "documents").selectExpr(*FILE_COLUMNS)


def q28_file_label(spark, sf_dir):
    return op.label_files(_file_rows(spark, sf_dir)).select("row_pos", "src_file", "Watchlist")


def q28b_recognise_files(spark, sf_dir):
    return op.recognise_files(_file_rows(spark, sf_dir))


# -- sources with colliding names -------------------------------------------

FEED_FILE = "sanctions_cleaned_2025-07-30.csv"
LIST_FILE = "sanctions_cleaned_un_20250730_230005.csv"

# A fifth of the feed shares one name, and nameless rows are in every source.
FEED_PARTY = (
    """CASE WHEN bal > 9000 THEN NULL WHEN seg = 'HOUSEHOLD' THEN 'Hot Party'
      ELSE 'Party ' || nk || ' ' || seg END AS Name""",
    "CASE WHEN seg = 'MACHINERY' THEN 'Entity' WHEN bal > 0 THEN 'Individual' END AS Type",
    "CASE WHEN bal > 5000 THEN '1958-' || (nk + 1) || '-2' ELSE '5 Jan 19' || (nk + 50) END AS DOB_DJ",
    "'OFAC - Specially Designated National List' AS Watchlist",
    "key AS row_pos",
)
LIST_PARTY = (
    "CASE WHEN bal < 0 THEN NULL ELSE 'Party ' || nk || ' MACHINERY' END AS Name",
    "'Entity' AS Type",
    "'UN Security Council' AS Source",
    "'QE.' || key AS Reference_Number",
    "key AS row_pos",
)
ANSWER_PARTY = (
    "CASE WHEN p_size = 50 THEN NULL WHEN p_type = 'PROMO' THEN 'Hot Party' ELSE p_name END AS Name",
    "CASE WHEN p_size < 10 THEN 'Vessel' ELSE 'Entity' END AS Type",
    "CASE WHEN p_type = 'SMALL' THEN '3/4/1960' END AS DOB_DJ",
    """CASE WHEN p_type = 'LARGE' THEN NULL WHEN p_type = 'MEDIUM' THEN 'Museum'
      ELSE 'Regulation 2024/9' END AS Watchlist""",
    "p_partkey AS row_pos",
    "'sanctions_from_2025' || lpad(substr(p_brand, 7), 5, '0') || '_t.csv' AS src_file",
)


def _parties(spark, sf_dir, feed_rank=0, list_rank=0, answer_rank=1):
    feed = customers(spark, sf_dir).selectExpr(*FEED_PARTY)
    listed = suppliers(spark, sf_dir).selectExpr(*LIST_PARTY)
    answers = wide_table(spark, sf_dir, "part").selectExpr(*ANSWER_PARTY)
    return op.unite(
        op.tag_source(feed, feed_rank, FEED_FILE, "row_pos"),
        op.tag_source(listed, list_rank, LIST_FILE, "row_pos"),
        op.tag_source(answers, answer_rank, F.col("src_file"), "row_pos"),
    )


SHOWN = ("Name", "Type", "DOB_DJ", "Watchlist", "Source", "Reference_Number", "src_file", "row_pos")


def q31_union_schemas(spark, sf_dir):
    return _parties(spark, sf_dir).select(*SHOWN)


def q31b_aligned_columns(spark, sf_dir):
    """The list's own columns under the feed's names."""
    listed = suppliers(spark, sf_dir).selectExpr(
        "key", "'1970' AS Date_of_Birth", "nation AS Nationalities", "name AS Name"
    )
    feed = customers(spark, sf_dir).selectExpr(
        "key", "'1971' AS `Date of Birth`", "region AS Nationality", "name AS Name"
    )
    return op.unite(feed, op.align_columns(listed))


def q32_consolidated(spark, sf_dir):
    return op.consolidate(_parties(spark, sf_dir)).select(*SHOWN)


def q32b_consolidated_app(spark, sf_dir):
    """The interactive order: answers, feed, list; nothing normalised."""
    rows = _parties(spark, sf_dir, feed_rank=1, list_rank=2, answer_rank=0)
    return op.consolidate(rows, normalised=False).select(*SHOWN)


def q33_duplicate_count(spark, sf_dir):
    return reports.duplicate_count(_parties(spark, sf_dir))


QUERIES = {
    "q25_date_standardise": q25_date_standardise,
    "q26_date_converted_count": q26_date_converted_count,
    "q27_csv_union_scan": q27_csv_union_scan,
    "q27b_csv_files": q27b_csv_files,
    "q27c_csv_blocks": q27c_csv_blocks,
    "q28_file_label": q28_file_label,
    "q28b_recognise_files": q28b_recognise_files,
    "q29_regulation_number": q29_regulation_number,
    "q30_watchlist_standardise": q30_watchlist_standardise,
    "q30b_watchlist_top10": q30b_watchlist_top10,
    "q31_union_schemas": q31_union_schemas,
    "q31b_aligned_columns": q31b_aligned_columns,
    "q32_consolidated": q32_consolidated,
    "q32b_consolidated_app": q32b_consolidated_app,
    "q33_duplicate_count": q33_duplicate_count,
}

# -- check SQL ----------------------------------------------------------------

_STANDARD = f"""
  SELECT key, CASE
    WHEN status = 'P' AND price < 100000 THEN ''
    WHEN status = 'P' AND price < 200000 THEN strftime(day, '%d/%m/%y')
    WHEN status = 'P' AND price < 300000 THEN '31/02/' || year(day)
    WHEN status = 'P' THEN strftime(day, '%-d %b %Y') || ' (approx)'
    WHEN priority = '4-NOT SPECIFIED' AND dayofmonth(day) <= 12 THEN
      strftime(make_date(year(day), dayofmonth(day), month(day)), '%d %b %Y')
    WHEN priority = '5-LOW' AND price >= 150000 THEN ''
    ELSE strftime(day, '%d %b %Y') END AS "DOB_DJ"
  FROM ({ORDERS_SQL})
"""

_LABELLED = f"SELECT key, nk, nation, region, seg, bal, {RAW_LABEL} AS w FROM ({CUSTOMERS_SQL})"

_LABELS = f"""
  SELECT key, w, CASE
      WHEN seg = 'HOUSEHOLD' THEN CASE WHEN bal < 4000 THEN 'Unknown' WHEN bal < 6000 THEN 'UN'
        ELSE nation END
      WHEN seg = 'MACHINERY' THEN 'OFAC'
      WHEN seg = 'BUILDING' THEN CASE WHEN bal < 3000 THEN '2025/' || key WHEN bal < 6000 THEN 'UN'
        ELSE w END
      WHEN seg = 'AUTOMOBILE' THEN 'EU'
      WHEN region = 'EUROPE' THEN 'EU' ELSE w END AS watchlist,
    CASE WHEN seg = 'HOUSEHOLD' THEN CASE WHEN bal < 6000 THEN 'Unknown' ELSE nation END
      WHEN seg = 'MACHINERY' THEN 'OFAC'
      WHEN seg = 'BUILDING' AND bal < 3000 THEN '2025/' || key
      WHEN seg = 'AUTOMOBILE' AND bal >= 5000 THEN 'EU' ELSE w END AS strict_watchlist
  FROM ({_LABELLED})
"""


def _top(stage, column):
    counted = f"SELECT {column} AS value, count(*) AS n FROM ({_LABELS}) WHERE {column} IS NOT NULL GROUP BY 1"
    return f"""
      SELECT * FROM (SELECT 'value' AS kind, value, n, '{stage}' AS stage FROM ({counted})
        ORDER BY n DESC, value LIMIT 10)
      UNION ALL
      SELECT 'other values', NULL, count(*) - 10, '{stage}' FROM ({counted}) HAVING count(*) > 10
    """


_FILES = f"""
  SELECT row_pos, src_file, first_value(Source) OVER w AS s, first_value(Watchlist) OVER w AS l
  FROM (SELECT {', '.join(FILE_COLUMNS)} FROM documents)
  WINDOW w AS (PARTITION BY src_file ORDER BY row_pos)
"""

_LABEL_OF_FILE = """CASE WHEN s = 'UN Security Council' THEN 'UN' WHEN l LIKE 'OFAC%' THEN 'OFAC'
  WHEN l IS NOT NULL THEN l WHEN src_file LIKE '%_abc_%' THEN 'EU'
  WHEN src_file LIKE 'sanctions_from_%' THEN '2025/' || ltrim(substr(src_file, 20, 5), '0')
  ELSE 'Unknown' END"""


def _union_sql(feed=0, listed=0, answers=1):
    def nothing(*names):
        return ", ".join(f"CAST(NULL AS VARCHAR) AS {n}" for n in names)

    return f"""
      SELECT Name, Type, DOB_DJ, Watchlist, {nothing('Source', 'Reference_Number')},
        '{FEED_FILE}' AS src_file, row_pos, {feed} AS src_rank
      FROM (SELECT {', '.join(FEED_PARTY)} FROM ({CUSTOMERS_SQL}))
      UNION ALL
      SELECT Name, Type, {nothing('DOB_DJ', 'Watchlist')}, Source, Reference_Number,
        '{LIST_FILE}', row_pos, {listed}
      FROM (SELECT {', '.join(LIST_PARTY)} FROM ({SUPPLIERS_SQL}))
      UNION ALL
      SELECT Name, Type, DOB_DJ, Watchlist, {nothing('Source', 'Reference_Number')},
        src_file, row_pos, {answers}
      FROM (SELECT {', '.join(ANSWER_PARTY)} FROM part)
    """


def _first_sql(union):
    return f"""
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Name ORDER BY src_rank, src_file, row_pos)
        AS place FROM ({union})) WHERE place = 1
    """


_SHOWN_SQL = ", ".join(f'"{c}"' for c in SHOWN)

# Each file's label: fixed for feed and list; for answers the first row's own
# label, else the number in the file name.
CONSOLIDATED_SQL = f"""
  SELECT Name, Type,
    CASE WHEN DOB_DJ LIKE '1958-%' THEN '02 ' || strftime(TRY_CAST('2000-' ||
        lpad(split_part(DOB_DJ, '-', 2), 2, '0') || '-01' AS DATE), '%b') || ' 1958'
      WHEN DOB_DJ = '3/4/1960' THEN '03 Apr 1960' ELSE coalesce(DOB_DJ, '') END AS DOB_DJ,
    CASE WHEN src_file = '{FEED_FILE}' THEN 'OFAC' WHEN src_file = '{LIST_FILE}' THEN 'UN'
      WHEN first_label = 'Museum' THEN 'EU'
      ELSE coalesce(first_label, '2025/' || ltrim(substr(src_file, 20, 5), '0')) END AS Watchlist,
    Source, Reference_Number, src_file, row_pos, src_rank
  FROM (SELECT *, first_value(Watchlist) OVER (PARTITION BY src_file ORDER BY row_pos) AS first_label
    FROM ({_union_sql()}))
"""
# '1958-13-2' and beyond are no dates under any format and stay as written.
CONSOLIDATED_SQL = f"""
  SELECT Name, Type, coalesce(u.DOB_DJ, raw) AS DOB_DJ, Watchlist, Source, Reference_Number,
    src_file, row_pos, src_rank
  FROM ({CONSOLIDATED_SQL}) AS u JOIN (
    SELECT src_file, row_pos, DOB_DJ AS raw FROM ({_union_sql()})) USING (src_file, row_pos)
"""

CHECKS = {
    "q25_date_standardise": _STANDARD,
    "q26_date_converted_count": f"""
      SELECT count(*) FILTER (WHERE regexp_matches("DOB_DJ", '^[0-9]+ [A-Z][a-z][a-z] [0-9]{{4}}'))
        AS converted FROM ({_STANDARD})
    """,
    "q27_csv_union_scan": """
      WITH f AS (SELECT * FROM part WHERE p_type NOT IN ('PROMO', 'LARGE'))
      SELECT p_partkey AS key, 0 AS row_pos, p_name || ', ' || p_brand AS "Name", 'Entity' AS "Type",
        CASE WHEN p_size >= 30 THEN '1958' END AS "DOB_DJ", CAST(NULL AS VARCHAR) AS "Watchlist" FROM f
      UNION ALL SELECT p_partkey, 1, NULL, NULL, NULL, NULL FROM f
      UNION ALL SELECT p_partkey, 2, 'N/A ', 'none', NULL, NULL FROM f
    """,
    "q27b_csv_files": """
      SELECT p_partkey AS key, p_name || ', "' || p_brand || '",' || chr(10) || p_size AS "Name",
        CAST(NULL AS VARCHAR) AS "Type", CAST(NULL AS VARCHAR) AS "DOB_DJ", 'a, b' AS "Watchlist",
        0 AS src_rank, 'sanctions_cleaned_promo.csv' AS src_file FROM part WHERE p_type = 'PROMO'
      UNION ALL SELECT p_partkey, p_brand, 'Entity', CASE WHEN p_size >= 30 THEN '1958' END, NULL,
        0, 'sanctions_cleaned_large.csv' FROM part WHERE p_type = 'LARGE'
      UNION ALL SELECT p_partkey, CASE WHEN p_size > 9 THEN p_name END, NULL, NULL, NULL,
        1, 'sanctions_from_2025_t.csv' FROM part WHERE p_type NOT IN ('PROMO', 'LARGE')
    """,
    "q27c_csv_blocks": f"""
      SELECT key, {ORDER_NAME} AS "Name", strftime(day, '%Y') AS "DOB_DJ", 'a' || chr(10) || 'b' AS "Watchlist",
        'sanctions_cleaned_orders.csv' AS src_file FROM ({ORDERS_SQL})
    """,
    "q28_file_label": f"""
      SELECT row_pos, src_file, {_LABEL_OF_FILE} AS "Watchlist" FROM ({_FILES})
    """,
    "q28b_recognise_files": f"""
      SELECT DISTINCT src_file, CASE WHEN s = 'UN Security Council' THEN 'list'
        WHEN l LIKE 'OFAC%' THEN 'feed' ELSE 'unknown' END AS kind FROM ({_FILES})
    """,
    "q29_regulation_number": f"""
      SELECT key, {NUMBER} AS number, CASE
        WHEN priority = '1-URGENT' AND key > 0 THEN year(day) || '/' || key
        WHEN priority = '2-HIGH' AND key >= 10000000 AND ltrim(substr(CAST(key AS VARCHAR), 5), '0') != ''
          THEN substr(CAST(key AS VARCHAR), 1, 4) || '/' || ltrim(substr(CAST(key AS VARCHAR), 5), '0')
        ELSE 'EU' END AS label
      FROM ({ORDERS_SQL})
    """,
    "q30_watchlist_standardise": f"SELECT key, watchlist, strict_watchlist FROM ({_LABELS})",
    "q30b_watchlist_top10": f"{_top('before', 'w')} UNION ALL {_top('after', 'watchlist')}",
    "q31_union_schemas": f"SELECT {_SHOWN_SQL} FROM ({_union_sql()})",
    "q31b_aligned_columns": f"""
      SELECT key, '1970' AS "Date of Birth", nation AS "Nationality", name AS "Name" FROM ({SUPPLIERS_SQL})
      UNION ALL SELECT key, '1971', region, name FROM ({CUSTOMERS_SQL})
    """,
    "q32_consolidated": f"SELECT {_SHOWN_SQL} FROM ({_first_sql(CONSOLIDATED_SQL)})",
    "q32b_consolidated_app": f"SELECT {_SHOWN_SQL} FROM ({_first_sql(_union_sql(1, 2, 0))})",
    "q33_duplicate_count": f"""
      SELECT count(*) AS total, count(*) - count(DISTINCT Name) -
        CASE WHEN count(*) > count(Name) THEN 1 ELSE 0 END AS duplicates FROM ({_union_sql()})
    """,
}
