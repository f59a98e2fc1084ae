"""List rows out of running text, by rule.

Records are parted by their numbering ("1.", "2)" at the start of a line). Within one, the
name comes first, and markers such as "born" or "passport no." begin a field each, which
ends at the next marker. What is found is laid out as a header and its cells, so the rules
for tables in :mod:`rollcall.operators.markdown` work out the columns. The rules are this
library's own and read what they describe, no more.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import strip
from rollcall.operators.rows import explode_once

RECORD_START = r"(?m)^[ \t]*\d{1,6}[.)][ \t]+"
#: Header of a field, and the words that begin it; longer ones come before their parts.
MARKERS = {
    "Place of birth": r"place of birth|born in|pob",
    "Date of birth": r"date of birth|born on|born|dob",
    "Aliases": r"also known as|formerly known as|alias(?:es)?|a\.?k\.?a\.?|f\.?k\.?a\.?",
    "Gender": r"gender|sex",
    "Nationality": r"nationality|citizenship|citizen of|national of",
    "Passport": r"passport (?:number|no\.?)|passport",
    "IMO": r"imo (?:number|no\.?)|imo",
    "INN": r"tax (?:number|id)|inn",
    "Registration Number": r"registration (?:number|no\.?)|registered under (?:number|no\.?)",
    "Country": r"country|flag",
    "Address": r"addresses|address",
    "Date of listing": r"date of listing|listed on",
    "Reasons": r"reasons?|other information|remarks?",
}
_MARK, _END = "\x01", "\x02"
_EDGES = r"^[\s,;.:()]+|[\s,;:(]+\z"


def _marked(record: Column) -> Column:
    """The record with a sign before every marker, and its field's header in the marker's place."""
    out = F.translate(record, _MARK + _END, "  ")
    for header, words in MARKERS.items():
        # A word that is already the header of a field stands right behind a sign.
        out = F.regexp_replace(out, rf"(?i)(?<![\w\x01])(?:{words})(?![\w\x02])\s*[:.]?", f"{_MARK}{header}{_END}")
    return out


def _bare(text: Column) -> Column:
    """Without the punctuation and blanks that part fields, the full stop of a sentence, and a parenthesis opened before."""
    closed = F.regexp_replace(F.regexp_replace(text, _EDGES, ""), r"(?<=[\w)])\.\z", "")
    return F.regexp_replace(closed, r"\A([^(]*)\)\s*\z", "$1")


def prose_rows(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per numbered record: (row_no, header, cells); a text without numbering has none."""
    unix = F.regexp_replace(F.col(text), r"\r\n?", "\n")
    parts = F.split(unix, RECORD_START)
    records = F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1)))
    rows = explode_once(df.select(*keep, F.col(text)), records, "row_no", "record", *keep)
    # A record ends at the first empty line.
    own = F.regexp_replace(F.regexp_extract("record", r"(?s)\A(.*?)(?:\n[ \t]*\n.*)?\z", 1), r"\s+", " ")
    fields = rows.select(*keep, F.col("row_no").cast("long").alias("row_no"), F.split(_marked(own), _MARK).alias("fields"))
    rest = F.slice("fields", F.lit(2), F.greatest(F.size("fields"), F.lit(1)))
    header = F.transform(rest, lambda f: F.substring_index(f, _END, 1))
    cells = F.transform(rest, lambda f: _bare(F.substring_index(f, _END, -1)))
    name = strip(_bare(F.get("fields", F.lit(0))))
    return fields.select(
        *keep, "row_no", F.concat(F.array(F.lit("Name")), header).alias("header"), F.concat(F.array(name), cells).alias("cells"))
