"""Watchlist labels and file classes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall import fixed_values as fv
from rollcall.functions.text import contains_any, not_empty, strip


def regulation_label(number: Column) -> Column:
    """'202501578' -> '2025/1578'; anything that is not such a number -> 'EU'."""
    rest = F.ltrim(F.substring(number, 5, 1 << 30), F.lit("0"))
    named = F.concat(F.substring(number, 1, 4), F.lit("/"), rest)
    return F.when(number.rlike(r"^\d{8,}\z") & not_empty(rest), named).otherwise(
        F.lit(fv.EU_LABEL)
    )


def _mentions(c: Column, words, strict: bool) -> Column:
    if strict:
        return c.rlike(r"(?i)\b(?:" + "|".join(words) + r")\b")
    return contains_any(F.lower(c), words)


def standard_watchlist(c: Column, strict: bool = False) -> Column:
    """One label per list.

    By default the short words match anywhere ('Unknown' and 'Council' hold
    'un', 'Museum' holds 'eu'); ``strict`` asks for whole words.
    """
    s = strip(c)
    return (
        F.when(~F.coalesce(not_empty(c), F.lit(False)), F.lit(fv.UNKNOWN_LABEL))
        .when(_mentions(s, fv.UN_WORDS, strict), F.lit(fv.UN_LABEL))
        .when(_mentions(s, fv.OFAC_WORDS, strict), F.lit(fv.OFAC_LABEL))
        .when(s.rlike(fv.REGULATION_IN_TEXT), s)
        .when(_mentions(s, fv.EU_WORDS, strict), F.lit(fv.EU_LABEL))
        .otherwise(s)
    )


def is_feed_watchlist(watchlist: Column) -> Column:
    """The first row of a delta-feed export names its list."""
    return F.coalesce(F.lower(watchlist).contains("ofac"), F.lit(False))


def is_list_source(source: Column) -> Column:
    """The first row of a full-list export names its source."""
    return F.coalesce(contains_any(F.lower(source), fv.UN_SOURCE_WORDS), F.lit(False))


def file_label(file_name: Column, first_source: Column, first_watchlist: Column) -> Column:
    """The label every row of a file gets, decided by its first row and name."""
    first = F.lower(first_watchlist)
    number = F.regexp_extract(file_name, fv.REGULATION_PREFIX + r"(\d+)_", 1)
    return (
        F.when(is_list_source(first_source), F.lit(fv.UN_LABEL))
        .when(contains_any(first, fv.OFAC_FIRST_ROW_WORDS), F.lit(fv.OFAC_LABEL))
        .when(not_empty(first) & (first != "nan"), first_watchlist)
        .when(file_name.contains(fv.REGULATION_PREFIX), regulation_label(number))
        .otherwise(F.lit(fv.UNKNOWN_LABEL))
    )


def file_class(file_name: Column) -> Column:
    """'pdf', 'ofac', 'un' or 'other', by file name alone."""
    lowered = F.lower(file_name)
    return (
        F.when(file_name.contains(fv.REGULATION_PREFIX), F.lit("pdf"))
        .when(lowered.contains("ofac"), F.lit("ofac"))
        .when(lowered.contains("un"), F.lit("un"))
        .otherwise(F.lit("other"))
    )


def is_transient(message: Column) -> Column:
    """True for an error text that a retry may cure."""
    return F.coalesce(contains_any(F.lower(message), fv.TRANSIENT_MARKERS), F.lit(False))
