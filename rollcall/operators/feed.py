"""Delta-feed entities, nested as parsed, to flat records.

All repeated groups stay arrays inside the record until the final join into
text, so no step explodes or shuffles.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import fixed_values as fv
from rollcall.functions import dates
from rollcall.functions.text import (
    join_items, kept, lookup, not_empty, or_empty, strip,
)


def added_only(entities: DataFrame) -> DataFrame:
    return entities.filter(F.col("_action") == fv.FEED_ACTION)


def entity_type(element: Column) -> Column:
    """Decode the type; '' without an element, 'Type None' without a code."""
    return F.when(
        element.isNotNull(), lookup(element["_refId"], fv.ENTITY_TYPES, "Type ")
    ).otherwise(F.lit(""))


PRIMARY = "coalesce(n.isPrimary = 'true', false)"


def _full_names(which: str) -> Column:
    """All non-empty spellings of the chosen names, in document order."""
    return F.expr(f"""
      filter(
        flatten(transform(
          filter(coalesce(names.name, array()), n -> {which}),
          n -> coalesce(transform(n.translations.translation, t -> t.formattedFullName), array()))),
        s -> length(s) > 0)
    """)


def primary_name() -> Column:
    """First spelling of a primary name; further primary spellings are dropped."""
    return or_empty(F.get(_full_names(PRIMARY), F.lit(0)))


def aliases() -> Column:
    """Every spelling of every other name, repeats included."""
    return join_items(_full_names(f"NOT {PRIMARY}"))


def feature_values(type_id: str) -> Column:
    """The non-empty values of one feature type, in document order."""
    return F.expr(f"""
      transform(
        filter(coalesce(features.feature, array()),
               f -> f.type._featureTypeId = '{type_id}' AND length(f.value) > 0),
        f -> f.value)
    """)


def last_value(values: Column) -> Column:
    return or_empty(F.try_element_at(values, F.lit(-1)))


def gender(value: Column) -> Column:
    lowered = F.lower(value)
    return F.when(lowered.isin("male", "female"), lowered).otherwise(value)


def country(type_name: Column, flag: Column, nationalities: Column, addresses: Column) -> Column:
    """A vessel's flag, else the first nationality, else the first address."""
    first_nationality = strip(F.split_part(join_items(nationalities), F.lit(";"), F.lit(1)))
    first_address = F.get(kept(addresses["country"]), F.lit(0))
    return (
        F.when((type_name == "Vessel") & not_empty(flag), flag)
        .when(F.size(nationalities) > 0, first_nationality)
        .otherwise(or_empty(first_address))
    )


def usable_documents(documents: Column) -> Column:
    """Documents with a type element and a number; others take no place."""
    return F.filter(
        documents, lambda d: d["type"].isNotNull() & not_empty(d["documentNumber"])
    )


def document_type(code: Column) -> Column:
    return lookup(code, fv.DOCUMENT_TYPES, "Doc Type ")


def program_names(programs: Column) -> Column:
    return F.transform(programs, lambda p: lookup(p["_refId"], fv.PROGRAMS, "Program "))


def flatten_feed(entities: DataFrame, *keep: str) -> DataFrame:
    """Added, named entities as flat records; ``keep`` columns ride along."""
    parts = added_only(entities).select(
        *keep,
        entity_type(F.col("generalInfo.entityType")).alias("type_name"),
        "names",
        feature_values(fv.FEATURE_BIRTH_DATE).alias("births"),
        feature_values(fv.FEATURE_BIRTH_PLACE).alias("places"),
        feature_values(fv.FEATURE_GENDER).alias("genders"),
        feature_values(fv.FEATURE_NATIONALITY).alias("nationalities"),
        feature_values(fv.FEATURE_VESSEL_FLAG).alias("flags"),
        F.col("addresses.address").alias("addresses"),
        usable_documents(F.col("identityDocuments.identityDocument")).alias("documents"),
        F.get(F.col("sanctionsLists.sanctionsList"), F.lit(0)).alias("listing"),
        F.col("sanctionsPrograms.sanctionsProgram").alias("programs"),
    ).withColumn("dated", dates.dated_values(F.col("births")))

    def document(slot: int, field: Column) -> Column:
        return or_empty(F.when(F.size("documents") > slot, field))

    first, second = (F.get("documents", F.lit(i)) for i in (0, 1))
    listed = F.col("listing").isNotNull()
    flat = parts.select(
        *keep,
        primary_name().alias("Name"),
        aliases().alias("Aliases"),
        F.col("type_name").alias("Type"),
        last_value(F.col("births")).alias("Date of Birth"),
        last_value(F.col("places")).alias("Place of Birth"),
        gender(last_value(F.col("genders"))).alias("Gender"),
        join_items(F.col("nationalities")).alias("Nationality"),
        country(
            F.col("type_name"), last_value(F.col("flags")),
            F.col("nationalities"), F.col("addresses"),
        ).alias("COUNTRY"),
        document(0, first["documentNumber"]).alias("ID_1"),
        document(0, document_type(first["type"]["_refId"])).alias("ID_Type1"),
        document(1, second["documentNumber"]).alias("ID_2"),
        document(1, document_type(second["type"]["_refId"])).alias("ID_Type2"),
        F.when(listed, dates.listing_date(F.col("listing._datePublished")))
        .otherwise(F.lit("")).alias("Date of listing"),
        F.when(listed, F.lit(fv.FEED_WATCHLIST)).otherwise(F.lit("")).alias("Watchlist"),
        join_items(program_names(F.col("programs"))).alias("Other info"),
        dates.birth_day(F.col("dated")).alias("DOB_DJ"),
        dates.birth_year(F.col("dated")).alias("DOB_YEAR"),
    )
    return flat.filter(not_empty(F.col("Name")))
