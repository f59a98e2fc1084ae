"""Full list: q13 - q17."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.fixed_values import LIST_COLUMNS
from rollcall.functions.dates import generation_date
from rollcall.operators import full_list as op
from rollcall.operators.small_tables import shared_folder
from rollcall.plans import jobs
from rollcall.queries.build import NULL, element, only_if, several, some, xml
from rollcall.queries.tables import (
    CUSTOMERS_SQL, ORDERS_SQL, SUPPLIERS_SQL, customers, orders, suppliers, table,
)
from rollcall.schemas import LIST_CONTRACT, LIST_ENTITY, LIST_INDIVIDUAL
from rollcall.sources.xml import parse_column

# Blanks of several scripts around values: tab, no-break and ideographic space.
PAD_LEFT, PAD_RIGHT = "\t\u00a0", "\u3000 "


def individual_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, xml): one individual per customer."""
    record = xml(
        "INDIVIDUAL",
        FIRST_NAME=f"'{PAD_LEFT}' || name || '{PAD_RIGHT}'",
        SECOND_NAME="CASE WHEN seg = 'BUILDING' THEN '  ' ELSE lower(seg) END",
        THIRD_NAME=only_if("region != 'ASIA'", "nation || ' '"),
        FOURTH_NAME="CASE WHEN bal > 5000 THEN region ELSE '' END",
        REFERENCE_NUMBER="' QD.' || key",
        LISTED_ON="' 2025-07-30'",
        GENDER=only_if("bal > 0", "'Male '"),
        COMMENTS1="'a < b & ' || nation",
        DESIGNATION=several(
            element(VALUE=several("seg || ' '", "''", "'   '")),
            element(VALUE=f"CASE WHEN region = 'EUROPE' THEN {several('nation', 'nation')} END"),
        ),
        NATIONALITY=several(
            element(VALUE=several("nation")),
            element(VALUE=only_if("seg = 'MACHINERY'", several("region"))),
        ),
        INDIVIDUAL_ALIAS=some(
            element(ALIAS_NAME="' ' || upper(name)", QUALITY="'Good'"),
            element(ALIAS_NAME="nation", QUALITY="''"),
            element(ALIAS_NAME="' '", QUALITY="'Low'"),
            only_if("seg = 'FURNITURE'", element(ALIAS_NAME="seg", QUALITY=NULL)),
        ),
        INDIVIDUAL_DATE_OF_BIRTH=some(
            only_if("seg = 'HOUSEHOLD'", element(DATE="'1970-01-' || (nk + 1)", YEAR="'1970'", NOTE=NULL)),
            only_if("region != 'AFRICA'", element(DATE="' '", YEAR="CAST(1950 + nk AS STRING)", NOTE="'n'")),
            only_if("bal < 1000", element(DATE=NULL, YEAR="''", NOTE="' approx '")),
            element(DATE=NULL, YEAR=NULL, NOTE="''"),
        ),
        INDIVIDUAL_PLACE_OF_BIRTH=some(
            element(CITY="seg", STATE_PROVINCE="'  '", COUNTRY="nation"),
            element(CITY=NULL, STATE_PROVINCE="''", COUNTRY=NULL),
            only_if("bal > 0", element(CITY=NULL, STATE_PROVINCE=NULL, COUNTRY="' ' || region")),
        ),
        INDIVIDUAL_ADDRESS=some(
            element(STREET="'Street ' || key", CITY="seg", STATE_PROVINCE=NULL, COUNTRY="nation", NOTE="' n '"),
            element(STREET=NULL, CITY=NULL, STATE_PROVINCE=NULL, COUNTRY="' '", NOTE="'note only'"),
            only_if("seg = 'BUILDING'",
                    element(STREET=NULL, CITY="nation", STATE_PROVINCE="region", COUNTRY=NULL, NOTE="' '")),
        ),
    )
    return customers(spark, sf_dir).selectExpr("key", record)


def entity_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, xml): one entity per supplier."""
    record = xml(
        "ENTITY",
        FIRST_NAME=f"name || '{PAD_RIGHT}'",
        SECOND_NAME="'not read'",
        REFERENCE_NUMBER="'QE.' || key",
        LISTED_ON="'2025-07-30'",
        COMMENTS1=NULL,
        ENTITY_ALIAS=some(
            element(ALIAS_NAME="nation", QUALITY="'a.k.a. '"),
            only_if("bal > 5000", element(ALIAS_NAME="region", QUALITY="' '")),
        ),
        ENTITY_ADDRESS=some(
            element(STREET=NULL, CITY="' ' || nation", STATE_PROVINCE="''", COUNTRY="region", NOTE="'n'"),
            only_if("bal > 0", element(STREET="'Road ' || key", CITY=NULL, STATE_PROVINCE=NULL,
                                       COUNTRY=NULL, NOTE=NULL)),
        ),
    )
    return suppliers(spark, sf_dir).selectExpr("key", record)


LISTED = """CASE priority WHEN '1-URGENT' THEN date_format(day, 'yyyy-MM-dd')
  WHEN '2-HIGH' THEN date_format(day, 'yyyy-M-d')
  WHEN '3-MEDIUM' THEN date_format(day, 'yyyy-MM-dd')
  WHEN '4-NOT SPECIFIED' THEN date_format(day, 'yyyy-MM-dd')
  ELSE CASE WHEN price < 100000 THEN ' ' || date_format(day, 'yyyy-MM-dd')
    WHEN price < 200000 THEN date_format(day, 'dd/MM/yyyy') WHEN price < 300000 THEN ''
    ELSE date_format(day, 'yyyy-MM-dd') END END"""


def q13_list_recent(spark, sf_dir):
    """Both sections of a list generated on the day of the newest order."""
    dated = orders(spark, sf_dir)
    stamp = table(spark, sf_dir, "orders").agg(F.max("o_orderdate").cast("date").alias("day")).select(
        F.expr("date_format(day, 'yyyy-MM-dd') || 'T23:00:05.333Z'").alias("stamp")
    )
    gen_date = stamp.select(generation_date(F.col("stamp"), F.lit(None).cast("date"))).scalar()
    fields = {"FIRST_NAME": "'Party ' || key", "REFERENCE_NUMBER": "'R' || key", "LISTED_ON": LISTED}
    individuals = dated.filter("status != 'P'").selectExpr("key", xml("INDIVIDUAL", **fields))
    entities = dated.filter("status = 'P'").selectExpr("key", xml("ENTITY", **fields))
    return op.flatten_list(
        op.recent_only(parse_column(individuals, "xml", LIST_INDIVIDUAL, "INDIVIDUAL", "key"), gen_date),
        op.recent_only(parse_column(entities, "xml", LIST_ENTITY, "ENTITY", "key"), gen_date),
        "key",
    ).select("key", "Type", "Name", "Reference_Number", "Listed_On", "Source")


def q13b_list_landing(spark, sf_dir):
    """The same list written as files, which name their day, and landed."""
    folder = f"{shared_folder(spark)}/rollcall/{uuid.uuid4().hex}"
    newest = table(spark, sf_dir, "orders").agg(F.max("o_orderdate").cast("date")).first()[0]
    fields = {"FIRST_NAME": "'Party ' || key", "REFERENCE_NUMBER": "'R' || key", "LISTED_ON": LISTED}
    dated = orders(spark, sf_dir)
    records = dated.filter("status != 'P'").selectExpr(xml("INDIVIDUAL", **fields)).union(dated.filter("status = 'P'").selectExpr(xml("ENTITY", **fields)))
    inside = F.concat(F.lit(f'<LIST dateGenerated="{newest}T23:00:05.333Z">'), "xml", F.lit("</LIST>"))
    records.select(inside.alias("value")).write.text(f"{folder}/list")
    landed = jobs.land_full_list(spark, f"{folder}/list", f"{folder}/out", "s", F.lit(None).cast("date"))
    rows = reduce(DataFrame.unionByName, landed, spark.createDataFrame([], LIST_CONTRACT))
    return rows.select("Type", "Name", "Reference_Number", "Listed_On", "Source")


def _individuals(spark, sf_dir):
    parsed = parse_column(individual_list(spark, sf_dir), "xml", LIST_INDIVIDUAL, "INDIVIDUAL", "key")
    return op.flatten_individuals(parsed, "key")


def _entities(spark, sf_dir):
    parsed = parse_column(entity_list(spark, sf_dir), "xml", LIST_ENTITY, "ENTITY", "key")
    return op.flatten_entities(parsed, "key")


def _from(records, *columns):
    def run(spark, sf_dir):
        return records(spark, sf_dir).select("key", *columns)
    return run


QUERIES = {
    "q13_list_recent": q13_list_recent,
    "q13b_list_landing": q13b_list_landing,
    "q14_list_names": _from(_individuals, "Type", "Name", "Reference_Number", "Listed_On", "Gender",
                            "Comments", "Source"),
    "q14b_list_entities": _from(_entities, *LIST_COLUMNS),
    "q15_list_aliases": _from(_individuals, "Designations", "Nationalities", "Aliases"),
    "q16_list_birth": _from(_individuals, "Date_of_Birth", "Place_of_Birth"),
    "q17_list_addresses": _from(_individuals, "Addresses"),
}

_ENTITIES_SQL = f"""
  SELECT key, 'Entity' AS "Type", name AS "Name", 'QE.' || key AS "Reference_Number",
    '2025-07-30' AS "Listed_On", '' AS "Gender", '' AS "Designations", '' AS "Nationalities",
    nation || ' (a.k.a.)' || CASE WHEN bal > 5000 THEN '; ' || region ELSE '' END AS "Aliases",
    '' AS "Date_of_Birth", '' AS "Place_of_Birth",
    nation || ', ' || region || CASE WHEN bal > 0 THEN '; Road ' || key ELSE '' END AS "Addresses",
    '' AS "Comments", 'UN Security Council' AS "Source"
  FROM ({SUPPLIERS_SQL})
"""

CHECKS = {
    "q13_list_recent": f"""
      SELECT key, CASE WHEN status = 'P' THEN 'Entity' ELSE 'Individual' END AS "Type",
        'Party ' || key AS "Name", 'R' || key AS "Reference_Number",
        CASE WHEN priority = '2-HIGH' THEN strftime(day, '%Y-%-m-%-d')
          ELSE strftime(day, '%Y-%m-%d') END AS "Listed_On",
        'UN Security Council' AS "Source"
      FROM ({ORDERS_SQL})
      WHERE day >= (SELECT max(CAST(o_orderdate AS DATE)) - 1 FROM orders)
        AND (priority != '5-LOW' OR price >= 300000)
    """,
    "q13b_list_landing": f"""
      SELECT CASE WHEN status = 'P' THEN 'Entity' ELSE 'Individual' END AS "Type",
        'Party ' || key AS "Name", 'R' || key AS "Reference_Number",
        CASE WHEN priority = '2-HIGH' THEN strftime(day, '%Y-%-m-%-d')
          ELSE strftime(day, '%Y-%m-%d') END AS "Listed_On",
        'UN Security Council' AS "Source"
      FROM ({ORDERS_SQL})
      WHERE day >= (SELECT max(CAST(o_orderdate AS DATE)) - 1 FROM orders)
        AND (priority != '5-LOW' OR price >= 300000)
    """,
    "q14_list_names": f"""
      SELECT key, 'Individual' AS "Type",
        concat_ws(' ', name, CASE WHEN seg != 'BUILDING' THEN lower(seg) END,
          CASE WHEN region != 'ASIA' THEN nation END,
          CASE WHEN bal > 5000 THEN region END) AS "Name",
        'QD.' || key AS "Reference_Number", '2025-07-30' AS "Listed_On",
        CASE WHEN bal > 0 THEN 'Male' ELSE '' END AS "Gender",
        'a < b & ' || nation AS "Comments", 'UN Security Council' AS "Source"
      FROM ({CUSTOMERS_SQL})
    """,
    "q14b_list_entities": _ENTITIES_SQL,
    "q15_list_aliases": f"""
      SELECT key,
        seg || '; ' || CASE WHEN region = 'EUROPE' THEN '; ' || nation || '; ' || nation ELSE '' END
          AS "Designations",
        nation || CASE WHEN seg = 'MACHINERY' THEN '; ' || region ELSE '' END AS "Nationalities",
        upper(name) || ' (Good); ' || nation || CASE WHEN seg = 'FURNITURE' THEN '; ' || seg ELSE '' END
          AS "Aliases"
      FROM ({CUSTOMERS_SQL})
    """,
    "q16_list_birth": f"""
      SELECT key,
        concat_ws('; ', CASE WHEN seg = 'HOUSEHOLD' THEN '1970-01-' || (nk + 1) END,
          CASE WHEN region != 'AFRICA' THEN CAST(1950 + nk AS VARCHAR) END,
          CASE WHEN bal < 1000 THEN 'approx' END) AS "Date_of_Birth",
        seg || ', ' || nation || CASE WHEN bal > 0 THEN '; ' || region ELSE '' END AS "Place_of_Birth"
      FROM ({CUSTOMERS_SQL})
    """,
    "q17_list_addresses": f"""
      SELECT key, 'Street ' || key || ', ' || seg || ', ' || nation || ' (n)' ||
        CASE WHEN seg = 'BUILDING' THEN '; ' || nation || ', ' || region ELSE '' END AS "Addresses"
      FROM ({CUSTOMERS_SQL})
    """,
}
