"""CSV held in a string column: records and fields, aware of quotes.

A quote counts only at the start of a field. The patterns are possessive, so
they run in linear time and never backtrack, however long a text is.
"""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import not_empty, null_tokens

QUOTED = r'"[^"]*+(?:""[^"]*+)*+"[^,\n]*+'
FIELD = rf"(?:{QUOTED}|[^,\n]*+)"
RECORD = rf"\n({FIELD}(?:,{FIELD})*+)"
INNER = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"(.*)$'


def csv_records(text: Column) -> Column:
    """The non-blank records of a CSV text, as written."""
    unix = F.regexp_replace(text, r"\r\n?", "\n")
    found = F.regexp_extract_all(F.concat(F.lit("\n"), unix), F.lit(RECORD), F.lit(1))
    return F.filter(found, not_empty)


def _unquoted(field: Column) -> Column:
    body = F.replace(F.regexp_extract(field, INNER, 1), F.lit('""'), F.lit('"'))
    quoted = field.startswith('"') & field.rlike(INNER)
    return F.when(quoted, F.concat(body, F.regexp_extract(field, INNER, 2))).otherwise(field)


def present(fields: Column) -> Column:
    """Fields with null for every text a CSV read takes as missing."""
    return F.transform(fields, null_tokens)


def csv_fields(record: Column) -> Column:
    """The fields of one record, quotes taken off."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({FIELD})"), F.lit(1))
    return F.transform(raw, _unquoted)


def places_of(header: Column, names: Sequence[str]) -> Column:
    """For every name its 1-based place in a header, 0 when it is not there."""
    wanted = ", ".join(f"'{n}'" for n in names)
    places = F.transform(F.expr(f"array({wanted})"), lambda n: F.array_position(header, n).cast("int"))
    return F.when(header.isNotNull(), places)


def fields_at(fields: str, places: str, names: Sequence[str]) -> list[Column]:
    """The named fields out of an array column, by their places."""
    picked = "try_element_at({}, nullif({}[{}], 0))"
    return [F.expr(picked.format(fields, places, i)).alias(n) for i, n in enumerate(names)]
