"""Markdown pipe tables in a text column."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import strip

RULE = r"[ \t]*\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)*+\|?[ \t]*"
TABLE = rf"\n([ \t]*\|[^\n]*+\n{RULE}(?:\n[ \t]*\|[^\n]*+)*+)"


def pipe_tables(text: Column) -> Column:
    """The pipe tables of a text: a header line, a rule, then rows."""
    unix = F.regexp_replace(text, r"\r\n?", "\n")
    return F.regexp_extract_all(F.concat(F.lit("\n"), unix), F.lit(TABLE), F.lit(1))


def pipe_cells(line: Column) -> Column:
    """The cells of one table line; an escaped pipe stays inside its cell."""
    inner = F.regexp_replace(F.regexp_replace(strip(line), r"^\|", ""), r"(?<!\\)\|\z", "")
    cells = F.split(inner, r"(?<!\\)\|", -1)
    return F.transform(cells, lambda c: F.replace(strip(c), F.lit("\\|"), F.lit("|")))
