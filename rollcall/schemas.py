"""Explicit schemas: every scan reads strings into one of these, none infers."""

from pyspark.sql import types as T

from rollcall.fixed_values import FEED_COLUMNS, LIST_COLUMNS


def strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


FEED_CONTRACT = strings(FEED_COLUMNS)
LIST_CONTRACT = strings(LIST_COLUMNS)

FEED_ENTITY = """
  _action string,
  generalInfo struct<entityType:struct<_refId:string,_VALUE:string>>,
  names struct<name:array<struct<isPrimary:string,
    translations:struct<translation:array<struct<formattedFullName:string>>>>>>,
  features struct<feature:array<struct<
    type:struct<_featureTypeId:string,_VALUE:string>,value:string>>>,
  addresses struct<address:array<struct<country:string>>>,
  identityDocuments struct<identityDocument:array<struct<
    type:struct<_refId:string,_VALUE:string>,documentNumber:string>>>,
  sanctionsLists struct<sanctionsList:array<struct<_datePublished:string,_VALUE:string>>>,
  sanctionsPrograms struct<sanctionsProgram:array<struct<_refId:string,_VALUE:string>>>
"""

LIST_INDIVIDUAL = """
  FIRST_NAME string, SECOND_NAME string, THIRD_NAME string, FOURTH_NAME string,
  REFERENCE_NUMBER string, LISTED_ON string, GENDER string, COMMENTS1 string,
  DESIGNATION array<struct<VALUE:array<string>>>,
  NATIONALITY array<struct<VALUE:array<string>>>,
  INDIVIDUAL_ALIAS array<struct<ALIAS_NAME:string,QUALITY:string>>,
  INDIVIDUAL_DATE_OF_BIRTH array<struct<DATE:string,YEAR:string,NOTE:string>>,
  INDIVIDUAL_PLACE_OF_BIRTH array<struct<CITY:string,STATE_PROVINCE:string,COUNTRY:string>>,
  INDIVIDUAL_ADDRESS array<struct<
    STREET:string,CITY:string,STATE_PROVINCE:string,COUNTRY:string,NOTE:string>>
"""

LIST_ENTITY = """
  FIRST_NAME string, REFERENCE_NUMBER string, LISTED_ON string, COMMENTS1 string,
  ENTITY_ALIAS array<struct<ALIAS_NAME:string,QUALITY:string>>,
  ENTITY_ADDRESS array<struct<
    STREET:string,CITY:string,STATE_PROVINCE:string,COUNTRY:string>>
"""

CORRUPT_COLUMN = "_corrupt_record"

# Values keep their blanks: the feed is never stripped, and the recency filter
# of the full list must see LISTED_ON as written.
XML_OPTIONS = {
    "ignoreNamespace": "true",
    "ignoreSurroundingSpaces": "false",
    "attributePrefix": "_",
    "valueTag": "_VALUE",
    "mode": "PERMISSIVE",
}
