"""CSV answers and Markdown tables: q24, q38, q39."""

from pyspark.sql import functions as F

from rollcall.fixed_values import FEED_COLUMNS
from rollcall.functions.identifiers import IMO_WEIGHTS, INN_10_WEIGHTS, INN_12_WEIGHTS
from rollcall.operators import answers as op
from rollcall.operators import markdown as md
from rollcall.operators import prose
from rollcall.queries.tables import CUSTOMERS_SQL, SUPPLIERS_SQL, customers, suppliers, wide_table

HEADER = ",".join(FEED_COLUMNS)
SHORT_HEADER = ",".join(("Type", "Name") + FEED_COLUMNS[3:])  # 16 fields, two swapped

# Two records per part: one with commas, quotes and empty marks, one whose last
# long field runs over two lines.
ANSWER = f"""'```csv\\n' || CASE WHEN p_type = 'PROMO' THEN
    '{SHORT_HEADER}\\nEntity,"' || p_name || '",None,' || repeat(',', 9) || 'x' || p_size || ',,,'
  ELSE '{HEADER}\\n"' || p_name || ', ""' || p_brand || '\"\"\",' || p_type || ';a,Entity,None,N/A,,NA,'
    || p_brand || ',' || p_partkey || ',Registration Number,,,2025-07-30,2025/1578,plain,None,1970'
    || CASE WHEN p_size < 25 THEN '\\r\\n' ELSE '\\n' END
    || p_partkey || ',,Vessel,,,,,,"7,5",IMO,,,,,"two\\nlines ' || p_size || '",,' END
  || '\\n```' || CASE WHEN p_size > 40 THEN '  \\n' ELSE '' END"""


def _answers(spark, sf_dir):
    return wide_table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS key", f"{ANSWER} AS answer", "'reg_' || p_partkey || '.pdf' AS document"
    )


def q24_answer_parse(spark, sf_dir):
    return op.answer_rows(_answers(spark, sf_dir), "answer", "document", "key")


def q24b_answer_check(spark, sf_dir):
    return op.check_answers(_answers(spark, sf_dir), "answer", "key")


# One regulation text per supplier, holding two tables; one row is a cell short.
REGULATION = """'# Council Regulation (EU) 2025/' || (1000 + key) || '\\n\\n## Annex - Entities\\n'
  || '|Name|Registration Number|INN|Address|Date of listing|Reasons|\\n|---|:---:|---|---|---|---|\\n'
  || '| ' || name || ' Ltd \\u0416 | ' || key || '-77 | ' || CASE WHEN bal > 0 THEN CAST(nk AS STRING) ELSE '' END
  || ' | Street 1, ' || nation || ' | ' || (nk + 1) || '.7.2025 | a \\\\| b |\\n'
  || '|' || upper(name) || '||12|||\\n\\nText between | the tables.\\n\\n## Persons\\r\\n'
  || '| Full name | Date of birth | Place of birth | Gender | Nationality | Passport |\\r\\n'
  || '|-|-|-|-|-|-|\\r\\n| Person ' || key || ' | ' || CASE WHEN bal > 5000
     THEN (nk + 1) || ' Mar 1960' ELSE 'about 1961' END
  || ' | ' || region || ' | ' || CASE WHEN bal > 2000 THEN 'male' ELSE '-' END
  || ' | ' || nation || ' | P' || key || ' |\\n'"""


def _rows(spark, sf_dir):
    texts = suppliers(spark, sf_dir).selectExpr("key", f"{REGULATION} AS text")
    coded = texts.withColumn("code", md.regulation_code(F.col("text")))
    return md.table_rows(coded, "text", "key", "code")


def q38_md_table_rows(spark, sf_dir):
    return _rows(spark, sf_dir).select(
        "key", "table_no", "row_no", F.size("cells").cast("long").alias("n_cells"),
        F.array_join("header", "~").alias("header"), F.array_join("cells", "~").alias("cells"),
    )


def q38b_document_tables(spark, sf_dir):
    """Lines with pipes in the given documents, of which none is a table."""
    docs = wide_table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", F.size(md.pipe_tables(F.col("text"))).cast("long").alias("tables")
    )


def q39_md_field_rules(spark, sf_dir):
    return md.field_rules(_rows(spark, sf_dir), "code", "key", "table_no", "row_no")


# A ship number and two tax numbers per row, their check digits right or one too high.
def _check(digits, weights):
    return " + ".join(f"{w} * CAST(substr({digits}, {i + 1}, 1) AS INT)" for i, w in enumerate(weights))


NUMBERS = f"""
  SELECT key, right_one, imo || CAST(((({_check('imo', IMO_WEIGHTS)}) % 10) + off) % 10 AS VARCHAR(1)) AS imo,
    inn || CAST(((({_check('inn', INN_10_WEIGHTS)}) % 11 % 10) + off) % 10 AS VARCHAR(1)) AS inn,
    eleven || CAST(((({_check('eleven', INN_12_WEIGHTS[1])}) % 11 % 10) + off) % 10 AS VARCHAR(1)) AS long_inn
  FROM (SELECT *, ten || CAST(({_check('ten', INN_12_WEIGHTS[0])}) % 11 % 10 AS VARCHAR(1)) AS eleven
    FROM (SELECT o_orderkey AS key, o_orderstatus != 'F' AS right_one, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS off,
        lpad(CAST(o_orderkey % 1000000 AS VARCHAR(20)), 6, '9') AS imo, lpad(CAST(o_custkey AS VARCHAR(20)), 9, '7') AS inn,
        lpad(CAST(o_orderkey + o_custkey AS VARCHAR(20)), 10, '5') AS ten FROM {{orders}}))
"""
ID_TABLE = """'| Name | IMO | INN | Registration no. | Passport |\n|-|-|-|-|-|\n| n | IMO ' || imo || ' | '
  || inn || ' | ' || long_inn || ' | P ' || key || ' |\n'"""


def q39b_identifiers(spark, sf_dir):
    """Numbers of a table, their kinds told and checked by check digits."""
    numbers = spark.sql(NUMBERS, orders=wide_table(spark, sf_dir, "orders"))
    rows = md.table_rows(numbers.selectExpr("key", f"{ID_TABLE} AS text"), "text", "key")
    return md.row_identifiers(rows, "key")


# Two numbered records of running text per customer.
PROSE = """'Annex\n\n1. ' || name || ', also known as ' || nation || ', ' || seg || '; born on ' || (nk + 1) || ' Mar 1960, place of birth: '
  || region || ', citizen of ' || nation || '. Passport no. P' || key || ', address: Street ' || nk || ', ' || nation
  || '.\n2) Ship ' || key || ' (IMO number: 9' || nk || '), flag ' || nation || ', listed on '
  || CASE WHEN bal > 0 THEN '2025-07-30' ELSE 'an unknown day' END || '.\nReasons: owned by ' || name || '\n\nAn empty line ends it, born never.\n'"""


def q39c_prose_rules(spark, sf_dir):
    """Records of running text to the list columns."""
    texts = customers(spark, sf_dir).selectExpr("key", f"{PROSE} AS text", "'2025/' || (1000 + nk) AS code")
    return md.field_rules(prose.prose_rows(texts, "text", "key", "code"), "code", "key", "row_no")


QUERIES = {
    "q24_answer_parse": q24_answer_parse,
    "q24b_answer_check": q24b_answer_check,
    "q38_md_table_rows": q38_md_table_rows,
    "q38b_document_tables": q38b_document_tables,
    "q39_md_field_rules": q39_md_field_rules,
    "q39b_identifiers": q39b_identifiers,
    "q39c_prose_rules": q39c_prose_rules,
}


def _answer_row(part, pos, condition, **values):
    fields = [f"""{values.get(c.replace(' ', '_'), 'CAST(NULL AS VARCHAR)')} AS "{c}\"""" for c in FEED_COLUMNS]
    return f"""SELECT p_partkey AS key, CAST({pos} AS BIGINT) AS row_pos, {', '.join(fields)},
      'reg_' || p_partkey || '.pdf' AS "Source_File" FROM {part} WHERE {condition}"""


_FIELDS = {
    "first": {
        "Name": "replace(name, '#', ' ') || ' Ltd'", "Type": "'Entity'", "COUNTRY": "nation",
        "ID_1": "CASE WHEN bal > 0 THEN CAST(nk AS VARCHAR) ELSE key || '-77' END",
        "ID_Type1": "CASE WHEN bal > 0 THEN 'INN' ELSE 'Registration Number' END",
        "ID_2": "CASE WHEN bal > 0 THEN key || '-77' ELSE 'None' END",
        "ID_Type2": "CASE WHEN bal > 0 THEN 'Registration Number' ELSE 'None' END",
        "Date of listing": "lpad(CAST(nk + 1 AS VARCHAR), 2, '0') || '/07/2025'",
        "Other info": "'Street 1, ' || nation || '; a | b'",
    },
    "second": {
        "Name": "upper(replace(name, '#', ' '))", "Type": "'Entity'", "ID_1": "'12'", "ID_Type1": "'INN'",
    },
    "person": {
        "Name": "'Person ' || key", "Type": "'Individual'",
        "Date of Birth": "CASE WHEN bal > 5000 THEN lpad(CAST(nk + 1 AS VARCHAR), 2, '0') || '/03/1960' "
                         "ELSE 'about 1961' END",
        "Place of Birth": "region", "Nationality": "nation", "COUNTRY": "nation",
        "Gender": "CASE WHEN bal > 2000 THEN 'Male' ELSE 'Unknown' END",
        "ID_1": "'P' || key", "ID_Type1": "'Passport'",
        "DOB_DJ": "CASE WHEN bal > 5000 THEN lpad(CAST(nk + 1 AS VARCHAR), 2, '0') || ' Mar 1960' ELSE '1961' END",
        "DOB_YEAR": "CASE WHEN bal > 5000 THEN '1960' ELSE '1961' END",
    },
}


def _field_row(kind, table_no, row_no):
    values = {"Watchlist": "'2025/' || (1000 + key)", **_FIELDS[kind]}
    fields = [f"""{values.get(c, "'None'")} AS "{c}\"""" for c in FEED_COLUMNS]
    return f"SELECT key, CAST({table_no} AS BIGINT) AS table_no, CAST({row_no} AS BIGINT) AS row_no, {', '.join(fields)} FROM ({SUPPLIERS_SQL})"


def _prose_row(row_no, **values):
    given = {"Watchlist": "'2025/' || (1000 + nk)", **{k.replace("_", " ") if k.startswith(("Date", "Place", "Other")) else k: v for k, v in values.items()}}
    fields = [f"""{given.get(c, "'None'")} AS "{c}\"""" for c in FEED_COLUMNS]
    return f"SELECT key, CAST({row_no} AS BIGINT) AS row_no, {', '.join(fields)} FROM ({CUSTOMERS_SQL})"


_DAY = "lpad(CAST(nk + 1 AS VARCHAR), 2, '0')"
_HEADER_1 = "Name~Registration Number~INN~Address~Date of listing~Reasons"
_HEADER_2 = "Full name~Date of birth~Place of birth~Gender~Nationality~Passport"

CHECKS = {
    "q24_answer_parse": " UNION ALL ".join([
        _answer_row("part", 0, "p_type = 'PROMO'", Type="'Entity'", Name="p_name",
                    Watchlist="'x' || p_size"),
        _answer_row(
            "part", 0, "p_type != 'PROMO'", Name="""p_name || ', "' || p_brand || '"'""",
            Aliases="p_type || ';a'", Type="'Entity'", COUNTRY="p_brand",
            ID_1="CAST(p_partkey AS VARCHAR)", ID_Type1="'Registration Number'",
            Date_of_listing="'2025-07-30'", Watchlist="'2025/1578'", Other_info="'plain'",
            DOB_YEAR="'1970'",
        ),
        _answer_row(
            "part", 1, "p_type != 'PROMO'", Name="CAST(p_partkey AS VARCHAR)", Type="'Vessel'",
            ID_1="'7,5'", ID_Type1="'IMO'", Other_info="'two' || chr(10) || 'lines ' || p_size",
        ),
    ]),
    "q24b_answer_check": """
      SELECT p_partkey AS key, CAST(CASE WHEN p_type = 'PROMO' THEN 16 ELSE 17 END AS BIGINT) AS header_fields,
        p_type != 'PROMO' AS valid FROM part
    """,
    "q38_md_table_rows": f"""
      SELECT key, CAST(0 AS BIGINT) AS table_no, CAST(0 AS BIGINT) AS row_no, CAST(6 AS BIGINT) AS n_cells, '{_HEADER_1}' AS header,
        name || ' Ltd ' || chr(1046) || '~' || key || '-77~' ||
        CASE WHEN bal > 0 THEN CAST(nk AS VARCHAR) ELSE '' END || '~Street 1, ' || nation || '~' ||
        (nk + 1) || '.7.2025~a | b' AS cells FROM ({SUPPLIERS_SQL})
      UNION ALL
      SELECT key, 0, 1, 5, '{_HEADER_1}', upper(name) || '~~12~~' FROM ({SUPPLIERS_SQL})
      UNION ALL
      SELECT key, 1, 0, 6, '{_HEADER_2}', 'Person ' || key || '~' ||
        CASE WHEN bal > 5000 THEN (nk + 1) || ' Mar 1960' ELSE 'about 1961' END || '~' || region || '~' ||
        CASE WHEN bal > 2000 THEN 'male' ELSE '-' END || '~' || nation || '~P' || key
      FROM ({SUPPLIERS_SQL})
    """,
    "q38b_document_tables": """
      SELECT doc_id, len(regexp_extract_all(text,
        '(?m)^[ \\t]*\\|[^\\n]*\\n[ \\t]*\\|?[ \\t]*:?-+:?[ \\t]*(\\|[ \\t]*:?-+:?[ \\t]*)*\\|?[ \\t]*$'
      )) AS tables FROM documents
    """,
    "q39_md_field_rules": " UNION ALL ".join(
        [_field_row("first", 0, 0), _field_row("second", 0, 1), _field_row("person", 1, 0)]
    ),
    "q39b_identifiers": " UNION ALL ".join(
        f"SELECT key, CAST({no} AS BIGINT) AS id_no, {kind} AS kind, {number} AS number, {verified} AS verified FROM ({NUMBERS.replace('{orders}', 'orders')})"
        for no, kind, number, verified in (
            (0, "'IMO'", "'IMO ' || imo", "right_one"), (1, "'INN'", "inn", "right_one"),
            (2, "CASE WHEN right_one THEN 'INN' ELSE 'Registration Number' END", "long_inn", "CASE WHEN right_one THEN true END"),
            (3, "'Passport'", "'P ' || key", "CAST(NULL AS BOOLEAN)"))
    ),
    "q39c_prose_rules": " UNION ALL ".join([
        _prose_row(0, Name="replace(name, '#', ' ')", Aliases="nation || '; ' || seg", Type="'Individual'", Date_of_Birth=f"{_DAY} || '/03/1960'",
                   Place_of_Birth="region", Gender="'Unknown'", Nationality="nation", COUNTRY="nation", ID_1="'P' || key", ID_Type1="'Passport'",
                   Other_info="'Street ' || nk || ', ' || nation", DOB_DJ=f"{_DAY} || ' Mar 1960'", DOB_YEAR="'1960'"),
        _prose_row(1, Name="'Ship ' || key", Type="'Vessel'", COUNTRY="nation", ID_1="'9' || nk", ID_Type1="'IMO'",
                   Date_of_listing="CASE WHEN bal > 0 THEN '30/07/2025' ELSE 'an unknown day' END", Other_info="'owned by ' || name"),
    ]),
}
