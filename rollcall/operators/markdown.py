"""List rows out of regulation texts, by rule.

Where the records of a regulation come as pipe tables, the columns follow from
header words, key words and number patterns. The rules are this library's own:
same fields, same vocabulary and same 'None' for an empty field as the answers
in :mod:`rollcall.operators.answers`, but no claim to the same reading of free
text.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import fixed_values as fv
from rollcall.functions.dates import parse_any, parse_birth
from rollcall.functions.identifiers import identify
from rollcall.functions.markdown import pipe_cells, pipe_tables
from rollcall.functions.text import strip
from rollcall.operators.rows import explode_once

# Words that tell what a row is about, tried in this order.
TYPE_WORDS = {
    "Vessel": r"vessel|ship|tanker|imo number|\bimo\b",
    "Airport": r"airport",
    "Airplane": r"aircraft|airplane|aeroplane",
    "Port": r"\bport\b",
    "Entity": r"company|corporation|bank|ministry|\bllc\b|\bltd\b|\binc\b|\bgmbh\b|\bjsc\b|\bojsc\b|entit",
    "Individual": r"\bbirth\b|\bborn\b|passport|gender|\bmr\b|\bmrs\b|individual|person",
}

# Header words of the numbers worth keeping, most telling first.
ID_HEADERS = {
    "IMO": r"(?i)\bimo\b",
    "INN": r"(?i)\binn\b|tax",
    "Registration Number": r"(?i)registration",
    "Passport": r"(?i)passport",
}

NONE = "None"


def table_rows(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per table row: (table_no, row_no, header, cells)."""
    tables = explode_once(df, pipe_tables(F.col(text)), "table_no", "block", *keep)
    lines = tables.select(*keep, "table_no", F.split("block", "\n").alias("lines"))
    body = F.slice("lines", F.lit(3), F.size("lines"))
    header = pipe_cells(F.get("lines", F.lit(0))).alias("header")
    return explode_once(lines, body, "row_no", "line", *keep, "table_no", header).select(
        *keep, F.col("table_no").cast("long").alias("table_no"),
        F.col("row_no").cast("long").alias("row_no"), "header",
        pipe_cells(F.col("line")).alias("cells"),
    )


def _cell(pattern: str) -> Column:
    """The first non-empty cell whose header fits."""
    pairs = F.arrays_zip(F.col("header").alias("h"), F.col("cells").alias("c"))
    fit = F.filter(pairs, lambda p: p["h"].rlike(pattern) & (F.length(p["c"]) > 0))
    return F.get(fit, F.lit(0))["c"]


def latin_only(name: Column) -> Column:
    """A name in Latin letters, digits and common signs."""
    kept = F.regexp_replace(name, r"[^\p{IsLatin}\p{M}0-9 .,'&/()\-]", " ")
    return F.nullif(strip(F.regexp_replace(kept, r"\s+", " ")), F.lit(""))


def regulation_code(text: Column) -> Column:
    """The first code such as 2025/1578 in a text."""
    return F.nullif(F.regexp_extract(text, r"\b(\d{4}/\d+)\b", 1), F.lit(""))


def _type(context: Column) -> Column:
    words = [F.when(context.rlike(f"(?i){w}"), F.lit(t)) for t, w in TYPE_WORDS.items()]
    return F.coalesce(*words, F.lit("Entity"))


def _ids() -> Column:
    """(kind, number) of the numbers worth keeping, most telling first."""
    found = F.array(*[F.struct(F.lit(kind).alias("kind"), _cell(header).alias("number")) for kind, header in ID_HEADERS.items()])
    return F.filter(found, lambda i: i["number"].isNotNull())


def row_identifiers(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per identity number of a row: (id_no, kind, number, verified).

    Check digits decide the kind where the header names none that has them, and flag
    numbers that cannot be right; ``verified`` is null for kinds without check digits.
    """
    checked = F.transform(_ids(), lambda i: identify(i["kind"], i["number"]))
    return explode_once(rows, checked, "id_no", "id", *keep).select(*keep, F.col("id_no").cast("long").alias("id_no"), "id.*")


def field_rules(rows: DataFrame, code: str, *keep: str) -> DataFrame:
    """Table rows to the 17 list columns; ``code`` holds the regulation code."""
    context = F.concat_ws(" ", F.col("header"), F.col("cells"))
    read = rows.select(
        *keep,
        F.col(code).alias("code"),
        latin_only(_cell(r"(?i)^(?:full |ship )?name")).alias("name"),
        _cell(r"(?i)alias|also known|a\.?k\.?a").alias("aliases"),
        _type(context).alias("type"),
        _cell(r"(?i)date of birth|born").alias("birth"),
        _cell(r"(?i)place of birth").alias("place"),
        _cell(r"(?i)gender|sex").alias("gender"),
        _cell(r"(?i)nationality|citizenship").alias("nationality"),
        _cell(r"(?i)country").alias("country"),
        _cell(r"(?i)address").alias("address"),
        _cell(r"(?i)listing|listed").alias("listed"),
        _cell(r"(?i)reason|information|remark").alias("info"),
        _ids().alias("ids"),
    )
    person = F.col("type") == "Individual"
    born = F.coalesce(parse_birth(F.col("birth")), parse_any(F.col("birth")))
    in_address = F.nullif(strip(F.regexp_extract("address", r"([^,]*)\z", 1)), F.lit(""))
    gender = F.when(F.lower("gender").rlike("^f"), "Female").when(F.lower("gender").rlike("^m"), "Male")
    first, second = (F.get("ids", F.lit(i)) for i in (0, 1))
    year = F.coalesce(
        F.year(born).cast("string"),
        F.nullif(F.regexp_extract("birth", r"\b(\d{4})\b", 1), F.lit("")),
    )
    values = {
        "Name": F.col("name"),
        "Aliases": F.regexp_replace("aliases", r"\s*[;,]\s*", fv.ITEM_SEPARATOR),
        "Type": F.col("type"),
        "Date of Birth": F.when(person, F.coalesce(F.date_format(born, "dd/MM/yyyy"), F.col("birth"))),
        "Place of Birth": F.when(person, F.col("place")),
        "Gender": F.when(person, F.coalesce(gender, F.lit("Unknown"))),
        "Nationality": F.col("nationality"),
        "COUNTRY": F.coalesce(F.col("country"), in_address, F.col("nationality")),
        "ID_1": first["number"],
        "ID_Type1": first["kind"],
        "ID_2": second["number"],
        "ID_Type2": second["kind"],
        "Date of listing": F.coalesce(F.date_format(parse_any(F.col("listed")), "dd/MM/yyyy"), F.col("listed")),
        "Watchlist": F.col("code"),
        "Other info": F.concat_ws(fv.ITEM_SEPARATOR, "address", "info"),
        "DOB_DJ": F.when(person, F.coalesce(F.date_format(born, "dd MMM yyyy"), year)),
        "DOB_YEAR": F.when(person, year),
    }
    return read.select(
        *keep, *[F.coalesce(F.nullif(v, F.lit("")), F.lit(NONE)).alias(k) for k, v in values.items()]
    )
