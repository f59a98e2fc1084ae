"""Delta feed: q01 - q12."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.fixed_values import DOCUMENT_TYPES, FEED_COLUMNS, PROGRAMS
from rollcall.operators import feed as op
from rollcall.operators import reports
from rollcall.operators.lookups import decode_by_join
from rollcall.operators.small_tables import shared_folder
from rollcall.plans import jobs
from rollcall.queries.build import NULL, element, only_if, several, some, xml
from rollcall.queries.tables import (
    CUSTOMERS_SQL, ORDERS_SQL, SUPPLIERS_SQL, customers, orders, suppliers, wide_table,
)
from rollcall.schemas import CORRUPT_COLUMN, FEED_CONTRACT, FEED_ENTITY
from rollcall.sources.xml import parse_column, with_corrupt


# -- records derived from the tables ---------------------------------------


def _name(primary, *spellings):
    spelled = [element(formattedFullName=s) for s in spellings]
    return element(isPrimary=primary, translations=element(translation=several(*spelled)))


def _feature(type_id, value):
    return element(
        type=element(_featureTypeId=f"'{type_id}'", _VALUE="'feature'"), value=value
    )


def _document(type_id, number):
    return element(type=element(_refId=type_id, _VALUE="'document'"), documentNumber=number)


def _program(ref):
    return element(_refId=ref, _VALUE="'program'")


def _named(name):
    return element(name=several(_name("'true'", name)))


def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, seg, xml): one entity per customer, every group filled or left out."""
    both = "seg || ' & <' || nation || '>'"
    birth = """CASE region WHEN 'ASIA' THEN '1970-2-' || (nk + 1)
      WHEN 'EUROPE' THEN 'circa 19' || (nk + 50)
      WHEN 'AFRICA' THEN (nk + 1) || ' jan  1981' WHEN 'AMERICA' THEN 'unknown' END"""
    sex = """CASE seg WHEN 'HOUSEHOLD' THEN 'MALE' WHEN 'MACHINERY' THEN 'Female'
      WHEN 'BUILDING' THEN 'Other' WHEN 'AUTOMOBILE' THEN '' END"""
    code = """CASE seg WHEN 'HOUSEHOLD' THEN '600' WHEN 'MACHINERY' THEN '601'
      WHEN 'BUILDING' THEN '602' WHEN 'AUTOMOBILE' THEN '603' END"""
    published = """CASE region WHEN 'AFRICA' THEN '2024-1-5' WHEN 'AMERICA' THEN '05/01/2024'
      WHEN 'EUROPE' THEN '2024-02-30' WHEN 'MIDDLE EAST' THEN '2024-12-31' END"""
    no_type = "CAST(NULL AS STRUCT<_refId:STRING,_VALUE:STRING>)"
    household, machinery = "seg = 'HOUSEHOLD'", "seg = 'MACHINERY'"
    building, automobile = "seg = 'BUILDING'", "seg = 'AUTOMOBILE'"
    record = xml(
        "entity",
        _action="CASE WHEN bal < 0 THEN 'delete' WHEN bal < 9900 THEN 'add' END",
        generalInfo=element(
            entityType=only_if(
                "NOT (seg = 'FURNITURE' AND bal < 5000)", element(_refId=code, _VALUE="'type'")
            )
        ),
        names=element(
            name=some(
                _name(
                    f"CASE WHEN {automobile} AND region = 'AFRICA' THEN 'false' ELSE 'true' END",
                    "''", "name", "upper(name)",
                ),
                _name(NULL, both),
                _name("'TRUE'", "'  ' || nation", both),
                only_if("region = 'EUROPE'", _name("'true'", "'Second ' || name")),
            )
        ),
        features=element(
            feature=some(
                _feature("9", "nation"),
                _feature("9", "''"),
                only_if(household, _feature("9", "region")),
                only_if("region != 'MIDDLE EAST'", _feature("8", birth)),
                only_if(machinery, _feature("8", "'circa 1965'")),
                only_if("seg != 'FURNITURE'", _feature("224", sex)),
                only_if(household, _feature("10", "nation")),
                only_if(household, _feature("10", "region")),
                only_if(machinery, _feature("10", "nation || ' ; x'")),
                only_if(automobile, _feature("10", "nation")),
                only_if(automobile, _feature("10", "nation")),
                only_if(f"{building} AND bal > 3000", _feature("3", "nation || ' flag'")),
                only_if(automobile, _feature("3", "'Panama'")),
            )
        ),
        addresses=only_if(
            "NOT (seg = 'FURNITURE' AND region = 'ASIA')",
            element(address=several(
                element(country="''"), element(country="region"), element(country="nation")
            )),
        ),
        identityDocuments=element(
            identityDocument=some(
                only_if(household, _document("'1571'", "'P' || key")),
                only_if(household, _document("'1584'", "''")),
                only_if(household, element(type=no_type, documentNumber="'X'")),
                only_if(household, _document("'9'", "'Q' || key")),
                only_if(household, _document("'1626'", "'R'")),
                only_if(machinery, _document("'91264'", "'M' || key")),
            )
        ),
        sanctionsLists=only_if(
            "seg != 'AUTOMOBILE'",
            element(sanctionsList=several(element(_datePublished=published, _VALUE="'list'"))),
        ),
        sanctionsPrograms=element(
            sanctionsProgram=some(
                only_if(household, _program("'91901'")),
                only_if(household, _program("'91902'")),
                only_if(household, _program("'7'")),
                only_if(machinery, _program("'1560'")),
                only_if(building, _program(NULL)),
            )
        ),
    )
    return customers(spark, sf_dir).selectExpr("key", "seg", record)


def birth_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity per order, with one to three birth values from its date."""
    record = xml(
        "entity",
        _action="'add'",
        names=_named("'Party ' || key"),
        features=element(
            feature=some(
                only_if("priority IN ('1-URGENT', '3-MEDIUM')",
                        _feature("8", "date_format(day, 'd MMM yyyy')")),
                only_if("priority = '2-HIGH'", _feature("8", "date_format(day, 'yyyy-MM-dd')")),
                only_if("priority = '3-MEDIUM'", _feature("8", "'circa 1900, maybe 1901'")),
                only_if("priority = '4-NOT SPECIFIED'", _feature("8", "'circa ' || year(day)")),
                only_if("status = 'P'", _feature("8", "'unknown'")),
                only_if("status = 'P'", _feature("8", "''")),
            )
        ),
    )
    return orders(spark, sf_dir).selectExpr("key", record)


def document_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity per part, with up to five identity documents."""
    record = xml(
        "entity",
        _action="'add'",
        names=_named("p_name"),
        identityDocuments=element(
            identityDocument=some(
                only_if("p_type = 'PROMO'", _document("'1584'", "''")),
                only_if("p_size < 40", _document("'1608'", "p_brand || '/' || p_partkey")),
                only_if("p_type IN ('SMALL', 'LARGE')", _document(NULL, "'N'")),
                only_if("p_size < 25", _document("CAST(p_size AS STRING)", "p_name")),
                only_if("p_type = 'ECONOMY'", _document("'91761'", "upper(p_name)")),
            )
        ),
    )
    return wide_table(spark, sf_dir, "part").selectExpr("p_partkey AS key", record)


def listing_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity per order, listed on its date in a good or bad format."""
    published = """CASE priority WHEN '1-URGENT' THEN date_format(day, 'yyyy-MM-dd')
      WHEN '2-HIGH' THEN date_format(day, 'yyyy-M-d')
      WHEN '3-MEDIUM' THEN date_format(day, 'dd/MM/yyyy')
      WHEN '4-NOT SPECIFIED' THEN date_format(day, 'yyyy-MM-') || '31' END"""
    record = xml(
        "entity",
        _action="'add'",
        names=_named("'Party ' || key"),
        sanctionsLists=only_if(
            "status != 'P'",
            element(sanctionsList=several(
                element(_datePublished=published, _VALUE="'first'"),
                element(_datePublished="'1999-09-09'", _VALUE="'second'"),
            )),
        ),
    )
    return orders(spark, sf_dir).selectExpr("key", record)


def program_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity per supplier, its programs chosen by nation and region."""
    record = xml(
        "entity",
        _action="'add'",
        names=_named("name"),
        sanctionsPrograms=only_if(
            "region != 'ASIA'",
            element(sanctionsProgram=several(
                _program("CAST(nk + 1545 AS STRING)"),
                _program("'91901'"),
                _program("CASE WHEN bal > 0 THEN '91902' END"),
            )),
        ),
    )
    return suppliers(spark, sf_dir).selectExpr("key", record)


def flat(feed: DataFrame) -> DataFrame:
    return op.flatten_feed(parse_column(feed, "xml", FEED_ENTITY, "entity", "key"), "key")


# -- queries ----------------------------------------------------------------


def _customer_query(*columns):
    def run(spark, sf_dir):
        return flat(customer_feed(spark, sf_dir)).select("key", *columns)
    return run


def q06_feed_birth_dates(spark, sf_dir):
    return flat(birth_feed(spark, sf_dir)).select("key", "Date of Birth", "DOB_DJ", "DOB_YEAR")


def q08_feed_identity_docs(spark, sf_dir):
    return flat(document_feed(spark, sf_dir)).select("key", "ID_1", "ID_Type1", "ID_2", "ID_Type2")


def q09_feed_programs(spark, sf_dir):
    return flat(program_feed(spark, sf_dir)).select("key", "Other info")


def q09b_program_join(spark, sf_dir):
    """The same lookup against a dimension table, one program per row."""
    codes = suppliers(spark, sf_dir).select("key", (F.col("nk") + 1545).cast("string").alias("code"))
    return decode_by_join(codes, "code", PROGRAMS, "Program ", "program")


def q09c_document_type_join(spark, sf_dir):
    codes = wide_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("key"), (F.col("p_size") + 1560).cast("string").alias("code")
    )
    return decode_by_join(codes, "code", DOCUMENT_TYPES, "Doc Type ", "document_type")


def q10_feed_listing(spark, sf_dir):
    return flat(listing_feed(spark, sf_dir)).select("key", "Watchlist", "Date of listing")


def q11_type_counts(spark, sf_dir):
    records = flat(customer_feed(spark, sf_dir))
    return reports.value_counts(records, "Type", "Watchlist")


def q11b_type_metrics(spark, sf_dir):
    return reports.type_metrics(flat(customer_feed(spark, sf_dir)))


def q12_corrupt_records(spark, sf_dir):
    """Broken records are set aside; the others are read as usual."""
    broken = customer_feed(spark, sf_dir).select(
        "key",
        F.when(F.col("seg") == "MACHINERY", F.replace("xml", F.lit("</names>"), F.lit("")))
        .otherwise(F.col("xml")).alias("xml"),
    )
    parsed = parse_column(broken, "xml", with_corrupt(FEED_ENTITY), "entity", "key", "xml")
    return parsed.select(
        "key",
        F.col(CORRUPT_COLUMN).isNotNull().alias("corrupt"),
        F.coalesce(F.col(CORRUPT_COLUMN) == F.col("xml"), F.lit(False)).alias("text_kept"),
        op.primary_name().alias("Name"),
    )


# -- landed files -------------------------------------------------------------


def _landed(spark, sf_dir):
    """The customer feed written as files, a seventh of its records broken, and landed; the folder of its export."""
    folder = f"{shared_folder(spark)}/rollcall/{uuid.uuid4().hex}"
    written = customer_feed(spark, sf_dir).select(
        F.when(F.col("key") % 7 == 0, F.replace("xml", F.lit("</names>"), F.lit(""))).otherwise(F.col("xml")))
    written.write.text(f"{folder}/feed")
    return f"{folder}/out", jobs.land_feed(spark, f"{folder}/feed", f"{folder}/out", "2025-07-30")


def q01b_feed_landing(spark, sf_dir):
    """Feed files to their export, and the export read back."""
    landed = _landed(spark, sf_dir)[1]
    return landed if landed is not None else spark.createDataFrame([], FEED_CONTRACT)


def q12b_landing_rejects(spark, sf_dir):
    """What the landing set aside: every broken record, none of the others."""
    rejects = jobs.landing_rejects(spark, _landed(spark, sf_dir)[0])
    name = F.regexp_extract("record", "(Customer#[0-9]+)", 1)
    return rejects.select("reason", name.alias("name"), F.col("record").startswith("<entity").alias("whole"))


QUERIES = {
    "q01_feed_records": _customer_query(*FEED_COLUMNS),
    "q02_feed_type_decode": _customer_query("Type"),
    "q03_feed_primary_name": _customer_query("Name"),
    "q04_feed_aliases": _customer_query("Aliases"),
    "q05_feed_features": _customer_query("Place of Birth", "Gender", "Nationality"),
    "q06_feed_birth_dates": q06_feed_birth_dates,
    "q07_feed_country": _customer_query("COUNTRY"),
    "q08_feed_identity_docs": q08_feed_identity_docs,
    "q09_feed_programs": q09_feed_programs,
    "q09b_program_join": q09b_program_join,
    "q09c_document_type_join": q09c_document_type_join,
    "q10_feed_listing": q10_feed_listing,
    "q11_type_counts": q11_type_counts,
    "q11b_type_metrics": q11b_type_metrics,
    "q12_corrupt_records": q12_corrupt_records,
    "q01b_feed_landing": q01b_feed_landing,
    "q12b_landing_rejects": q12b_landing_rejects,
}


# -- check SQL --------------------------------------------------------------

_EXPECTED = f"""
  SELECT key, name AS "Name",
    seg || ' & <' || nation || '>; ' || '  ' || nation || '; ' || seg || ' & <' || nation || '>'
      AS "Aliases",
    CASE seg WHEN 'HOUSEHOLD' THEN 'Individual' WHEN 'MACHINERY' THEN 'Entity'
      WHEN 'BUILDING' THEN 'Vessel' WHEN 'AUTOMOBILE' THEN 'Type 603'
      ELSE CASE WHEN bal < 5000 THEN '' ELSE 'Type None' END END AS "Type",
    CASE WHEN seg = 'MACHINERY' THEN 'circa 1965'
      WHEN region = 'ASIA' THEN '1970-2-' || (nk + 1)
      WHEN region = 'EUROPE' THEN 'circa 19' || (nk + 50)
      WHEN region = 'AFRICA' THEN (nk + 1) || ' jan  1981'
      WHEN region = 'AMERICA' THEN 'unknown' ELSE '' END AS "Date of Birth",
    CASE WHEN seg = 'HOUSEHOLD' THEN region ELSE nation END AS "Place of Birth",
    CASE seg WHEN 'HOUSEHOLD' THEN 'male' WHEN 'MACHINERY' THEN 'female'
      WHEN 'BUILDING' THEN 'Other' ELSE '' END AS "Gender",
    CASE seg WHEN 'HOUSEHOLD' THEN nation || '; ' || region
      WHEN 'MACHINERY' THEN nation || ' ; x'
      WHEN 'AUTOMOBILE' THEN nation || '; ' || nation ELSE '' END AS "Nationality",
    CASE WHEN seg IN ('HOUSEHOLD', 'MACHINERY', 'AUTOMOBILE') THEN nation
      WHEN seg = 'BUILDING' AND bal > 3000 THEN nation || ' flag'
      WHEN seg = 'FURNITURE' AND region = 'ASIA' THEN '' ELSE region END AS "COUNTRY",
    CASE seg WHEN 'HOUSEHOLD' THEN 'P' || key WHEN 'MACHINERY' THEN 'M' || key ELSE '' END AS "ID_1",
    CASE seg WHEN 'HOUSEHOLD' THEN 'Passport' WHEN 'MACHINERY' THEN 'MMSI' ELSE '' END AS "ID_Type1",
    CASE seg WHEN 'HOUSEHOLD' THEN 'Q' || key ELSE '' END AS "ID_2",
    CASE seg WHEN 'HOUSEHOLD' THEN 'Doc Type 9' ELSE '' END AS "ID_Type2",
    CASE WHEN seg = 'AUTOMOBILE' THEN '' ELSE CASE region WHEN 'AFRICA' THEN '05/01/2024'
      WHEN 'AMERICA' THEN '05/01/2024' WHEN 'EUROPE' THEN '2024-02-30'
      WHEN 'MIDDLE EAST' THEN '31/12/2024' ELSE '' END END AS "Date of listing",
    CASE WHEN seg = 'AUTOMOBILE' THEN ''
      ELSE 'OFAC - Specially Designated National List' END AS "Watchlist",
    CASE seg WHEN 'HOUSEHOLD' THEN 'IRAN-EO13902; IRAN-EO13902; Program 7'
      WHEN 'MACHINERY' THEN 'RUSSIA-EO14024' WHEN 'BUILDING' THEN 'Program None' ELSE '' END
      AS "Other info",
    CASE region WHEN 'ASIA' THEN lpad(CAST(nk + 1 AS VARCHAR), 2, '0') || '/02/1970'
      WHEN 'AFRICA' THEN lpad(CAST(nk + 1 AS VARCHAR), 2, '0') || '/01/1981' ELSE '' END AS "DOB_DJ",
    CASE WHEN seg = 'MACHINERY' THEN '1965' WHEN region = 'ASIA' THEN '1970'
      WHEN region = 'EUROPE' THEN '19' || (nk + 50) WHEN region = 'AFRICA' THEN '1981'
      ELSE '' END AS "DOB_YEAR"
  FROM ({CUSTOMERS_SQL})
  WHERE bal >= 0 AND bal < 9900 AND NOT (seg = 'AUTOMOBILE' AND region = 'AFRICA')
"""


def _expected(*columns):
    return "SELECT key, " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({_EXPECTED})"


def _values(table_):
    return "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in table_.items()) + ")"


_LANDED = ", ".join(f"""nullif("{c}", '') AS "{c}\"""" for c in FEED_COLUMNS)

CHECKS = {
    "q01b_feed_landing": f"SELECT {_LANDED} FROM ({_EXPECTED}) WHERE key % 7 != 0",
    "q12b_landing_rejects": f"SELECT 'not well-formed' AS reason, name, true AS whole FROM ({CUSTOMERS_SQL}) WHERE key % 7 = 0",
    "q01_feed_records": _expected(*FEED_COLUMNS),
    "q02_feed_type_decode": _expected("Type"),
    "q03_feed_primary_name": _expected("Name"),
    "q04_feed_aliases": _expected("Aliases"),
    "q05_feed_features": _expected("Place of Birth", "Gender", "Nationality"),
    "q06_feed_birth_dates": f"""
      SELECT key,
        CASE WHEN status = 'P' THEN 'unknown'
          WHEN priority = '1-URGENT' THEN strftime(day, '%-d %b %Y')
          WHEN priority = '2-HIGH' THEN strftime(day, '%Y-%m-%d')
          WHEN priority = '3-MEDIUM' THEN 'circa 1900, maybe 1901'
          WHEN priority = '4-NOT SPECIFIED' THEN 'circa ' || year(day) ELSE '' END AS "Date of Birth",
        CASE WHEN priority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN strftime(day, '%d/%m/%Y')
          ELSE '' END AS "DOB_DJ",
        CASE WHEN priority = '3-MEDIUM' THEN '1900' WHEN priority = '5-LOW' THEN ''
          ELSE CAST(year(day) AS VARCHAR) END AS "DOB_YEAR"
      FROM ({ORDERS_SQL})
    """,
    "q07_feed_country": _expected("COUNTRY"),
    "q08_feed_identity_docs": """
      SELECT key, coalesce(docs[1].n, '') AS "ID_1", coalesce(docs[1].t, '') AS "ID_Type1",
        coalesce(docs[2].n, '') AS "ID_2", coalesce(docs[2].t, '') AS "ID_Type2"
      FROM (
        SELECT p_partkey AS key, list_filter([
          CASE WHEN p_size < 40 THEN {'n': p_brand || '/' || p_partkey, 't': 'Identification Number'} END,
          CASE WHEN p_type IN ('SMALL', 'LARGE') THEN {'n': 'N', 't': 'Doc Type None'} END,
          CASE WHEN p_size < 25 THEN {'n': p_name, 't': 'Doc Type ' || p_size} END,
          CASE WHEN p_type = 'ECONOMY' THEN {'n': upper(p_name), 't': 'Registration Number'} END
        ], lambda d: d IS NOT NULL) AS docs FROM part)
    """,
    "q09_feed_programs": f"""
      SELECT key, CASE WHEN region = 'ASIA' THEN '' ELSE
        coalesce(v, 'Program ' || (nk + 1545)) || '; IRAN-EO13902; ' ||
        CASE WHEN bal > 0 THEN 'IRAN-EO13902' ELSE 'Program None' END END AS "Other info"
      FROM ({SUPPLIERS_SQL}) LEFT JOIN {_values(PROGRAMS)} AS p(k, v)
        ON k = CAST(nk + 1545 AS VARCHAR)
    """,
    "q09b_program_join": f"""
      SELECT key, CAST(nk + 1545 AS VARCHAR) AS code,
        coalesce(v, 'Program ' || (nk + 1545)) AS program
      FROM ({SUPPLIERS_SQL}) LEFT JOIN {_values(PROGRAMS)} AS p(k, v)
        ON k = CAST(nk + 1545 AS VARCHAR)
    """,
    "q09c_document_type_join": f"""
      SELECT p_partkey AS key, CAST(p_size + 1560 AS VARCHAR) AS code,
        coalesce(v, 'Doc Type ' || (p_size + 1560)) AS document_type
      FROM part LEFT JOIN {_values(DOCUMENT_TYPES)} AS p(k, v)
        ON k = CAST(p_size + 1560 AS VARCHAR)
    """,
    "q10_feed_listing": f"""
      SELECT key,
        CASE WHEN status = 'P' THEN '' ELSE 'OFAC - Specially Designated National List' END
          AS "Watchlist",
        CASE WHEN status = 'P' OR priority = '5-LOW' THEN ''
          WHEN priority = '4-NOT SPECIFIED' THEN
            coalesce(strftime(TRY_CAST(strftime(day, '%Y-%m-31') AS DATE), '%d/%m/%Y'),
                     strftime(day, '%Y-%m-31'))
          ELSE strftime(day, '%d/%m/%Y') END AS "Date of listing"
      FROM ({ORDERS_SQL})
    """,
    "q11_type_counts": f"""
      SELECT 'Type' AS "column", "Type" AS value, count(*) AS n FROM ({_EXPECTED}) GROUP BY "Type"
      UNION ALL
      SELECT 'Watchlist', "Watchlist", count(*) FROM ({_EXPECTED}) GROUP BY "Watchlist"
    """,
    "q11b_type_metrics": f"""
      SELECT count(*) AS total, count(*) FILTER (WHERE "Type" = 'Individual') AS individuals,
        count(*) FILTER (WHERE "Type" = 'Entity') AS entities FROM ({_EXPECTED})
    """,
    "q12_corrupt_records": f"""
      SELECT key, seg = 'MACHINERY' AS corrupt, seg = 'MACHINERY' AS text_kept,
        CASE WHEN seg = 'MACHINERY' OR (seg = 'AUTOMOBILE' AND region = 'AFRICA') THEN ''
          ELSE name END AS "Name"
      FROM ({CUSTOMERS_SQL})
    """,
}
