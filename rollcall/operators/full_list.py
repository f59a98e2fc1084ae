"""Full-list individuals and entities, nested as parsed, to flat records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import fixed_values as fv
from rollcall.functions.dates import parse_iso
from rollcall.functions.text import join_items, join_parts, kept, not_empty, safe_text, strip


def recent_only(records: DataFrame, gen_date: Column) -> DataFrame:
    """Records listed on the generation day or the day before.

    LISTED_ON is read as written: blanks around it make it no date. The test
    sits on a top-level field, so it runs ahead of all flattening.
    """
    listed = parse_iso(F.col("LISTED_ON"))
    return records.filter(listed.between(F.date_sub(gen_date, fv.RECENT_DAYS), gen_date))


def full_name(*parts: Column) -> Column:
    return join_parts(*[safe_text(p) for p in parts], sep=" ")


def nested_values(groups: Column) -> Column:
    """Every non-empty VALUE of every group, stripped; a blank one stays as ''."""
    lists = F.filter(F.transform(groups, lambda g: g["VALUE"]), lambda v: v.isNotNull())
    return join_items(F.transform(kept(F.flatten(lists)), strip))


def qualified_aliases(aliases: Column) -> Column:
    """'name (quality)', or the name alone; nameless aliases are dropped."""

    def shown(a: Column) -> Column:
        name, quality = safe_text(a["ALIAS_NAME"]), safe_text(a["QUALITY"])
        full = F.concat(name, F.lit(" ("), quality, F.lit(")"))
        return F.when(not_empty(name) & not_empty(quality), full).otherwise(name)

    return join_items(kept(F.transform(aliases, shown)))


def birth_dates(births: Column) -> Column:
    """Per element the date, else the year, else the note."""

    def shown(b: Column) -> Column:
        tried = [F.nullif(safe_text(b[f]), F.lit("")) for f in ("DATE", "YEAR", "NOTE")]
        return F.coalesce(*tried)

    return join_items(kept(F.transform(births, shown)))


def _place(p: Column, *fields: str) -> Column:
    return join_parts(*[safe_text(p[f]) for f in fields])


def birth_places(places: Column) -> Column:
    shown = F.transform(places, lambda p: _place(p, "CITY", "STATE_PROVINCE", "COUNTRY"))
    return join_items(kept(shown))


def addresses(places: Column, with_note: bool) -> Column:
    """Addresses in one line each; a note alone makes no address."""

    def shown(p: Column) -> Column:
        line = _place(p, "STREET", "CITY", "STATE_PROVINCE", "COUNTRY")
        if not with_note:
            return line
        note = safe_text(p["NOTE"])
        noted = F.concat(line, F.lit(" ("), note, F.lit(")"))
        return F.when(not_empty(line) & not_empty(note), noted).otherwise(line)

    return join_items(kept(F.transform(places, shown)))


def flatten_individuals(records: DataFrame, *keep: str) -> DataFrame:
    c = F.col
    return records.select(
        *keep,
        F.lit("Individual").alias("Type"),
        full_name(c("FIRST_NAME"), c("SECOND_NAME"), c("THIRD_NAME"), c("FOURTH_NAME")).alias("Name"),
        safe_text(c("REFERENCE_NUMBER")).alias("Reference_Number"),
        safe_text(c("LISTED_ON")).alias("Listed_On"),
        safe_text(c("GENDER")).alias("Gender"),
        nested_values(c("DESIGNATION")).alias("Designations"),
        nested_values(c("NATIONALITY")).alias("Nationalities"),
        qualified_aliases(c("INDIVIDUAL_ALIAS")).alias("Aliases"),
        birth_dates(c("INDIVIDUAL_DATE_OF_BIRTH")).alias("Date_of_Birth"),
        birth_places(c("INDIVIDUAL_PLACE_OF_BIRTH")).alias("Place_of_Birth"),
        addresses(c("INDIVIDUAL_ADDRESS"), with_note=True).alias("Addresses"),
        safe_text(c("COMMENTS1")).alias("Comments"),
        F.lit(fv.LIST_SOURCE).alias("Source"),
    )


def flatten_entities(records: DataFrame, *keep: str) -> DataFrame:
    c = F.col
    blank = F.lit("")
    return records.select(
        *keep,
        F.lit("Entity").alias("Type"),
        safe_text(c("FIRST_NAME")).alias("Name"),
        safe_text(c("REFERENCE_NUMBER")).alias("Reference_Number"),
        safe_text(c("LISTED_ON")).alias("Listed_On"),
        blank.alias("Gender"),
        blank.alias("Designations"),
        blank.alias("Nationalities"),
        qualified_aliases(c("ENTITY_ALIAS")).alias("Aliases"),
        blank.alias("Date_of_Birth"),
        blank.alias("Place_of_Birth"),
        addresses(c("ENTITY_ADDRESS"), with_note=False).alias("Addresses"),
        safe_text(c("COMMENTS1")).alias("Comments"),
        F.lit(fv.LIST_SOURCE).alias("Source"),
    )


def flatten_list(individuals: DataFrame, entities: DataFrame, *keep: str) -> DataFrame:
    """Both sections as one table of flat records."""
    return flatten_individuals(individuals, *keep).unionByName(flatten_entities(entities, *keep))
