"""Date texts: every format is guarded by an anchored pattern and then parsed.

The guards mirror what C-style ``strptime`` accepts (one- or two-digit day and
month, four-digit year, any run of blanks between words), because Spark's own
parser is stricter on blanks and laxer on years.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import not_empty, or_empty, strip

# The accepted shapes.
DAY = r"(?:3[01]|[12]\d|0[1-9]|[1-9]| [1-9])"
MONTH = r"(?:1[0-2]|0[1-9]|[1-9])"
MONTH_NAME = r"(?i:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
YEAR = r"(?!0000)\d{4}"

NAMED = rf"^{DAY}\s+{MONTH_NAME}\s+{YEAR}\z"
ISO = rf"^{YEAR}-{MONTH}-{DAY}\z"
DAY_FIRST = rf"^{DAY}(?:/{MONTH}/|-{MONTH}-|\.{MONTH}\.|\s+{MONTH}\s+){YEAR}\z"
YEAR_FIRST = rf"^{YEAR}(?:-{MONTH}-|/{MONTH}/){DAY}\z"
MONTH_FIRST = rf"^{MONTH}/{DAY}/{YEAR}\z"

STANDARD_PREFIX = r"^\d{1,2}\s+[A-Za-z]{3}\s+\d{4}"
BARE_YEAR = r"(?U)\b(\d{4})\b"


def _when_shaped(text: Column, shape: str, cleaned: Column, pattern: str) -> Column:
    return F.when(text.rlike(shape), F.try_to_date(cleaned, pattern))


def parse_iso(c: Column) -> Column:
    """A date from year-month-day text; null unless the whole text is one."""
    return _when_shaped(c, ISO, F.replace(c, F.lit(" "), F.lit("")), "yyyy-M-d")


def parse_birth(c: Column) -> Column:
    """A date from '5 Jan 1970' or '1970-1-5'."""
    named = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.coalesce(_when_shaped(c, NAMED, named, "d MMM yyyy"), parse_iso(c))


def parse_any(c: Column) -> Column:
    """A date from any of the numeric formats; day-first wins over month-first."""
    digits = F.regexp_replace(c, r"\D+", "-")
    return F.coalesce(
        _when_shaped(c, DAY_FIRST, digits, "d-M-yyyy"),
        _when_shaped(c, YEAR_FIRST, digits, "yyyy-M-d"),
        _when_shaped(c, MONTH_FIRST, digits, "M-d-yyyy"),
    )


def slashed(d: Column) -> Column:
    return F.date_format(d, "dd/MM/yyyy")


def dated_values(values: Column) -> Column:
    """Birth-date values with the date each one holds, if any: (raw, d)."""
    return F.transform(values, lambda v: F.struct(v.alias("raw"), parse_birth(v).alias("d")))


def _last_set(arr: Column) -> Column:
    return F.try_element_at(F.filter(arr, lambda v: v.isNotNull()), F.lit(-1))


def birth_day(dated: Column) -> Column:
    """The last full date among a record's birth-date values."""
    return or_empty(slashed(_last_set(F.transform(dated, lambda x: x["d"]))))


def birth_year(dated: Column) -> Column:
    """The last year a value tells, by its date or as four digits.

    Day and year may stem from different values.
    """

    def told(x: Column) -> Column:
        digits = F.regexp_extract(x["raw"], BARE_YEAR, 1)
        return F.coalesce(F.year(x["d"]).cast("string"), F.nullif(digits, F.lit("")))

    return or_empty(_last_set(F.transform(dated, told)))


def listing_date(c: Column) -> Column:
    """Day/month/year when the text is a date, the text itself when not."""
    return F.coalesce(slashed(parse_iso(c)), c, F.lit(""))


def standardise_date(c: Column) -> Column:
    """'dd Mon yyyy' for every known format; other text stays as it is."""
    s = strip(c)
    done = s.rlike(STANDARD_PREFIX)
    return (
        F.when(~F.coalesce(not_empty(s), F.lit(False)), F.lit(""))
        .when(done, s)
        .otherwise(F.coalesce(F.date_format(parse_any(s), "dd MMM yyyy"), s))
    )


def is_standard_date(c: Column) -> Column:
    return F.coalesce(c.rlike(STANDARD_PREFIX), F.lit(False))


def generation_date(stamp: Column, fallback: Column) -> Column:
    """The day written in an ISO time stamp, in the offset it is written in."""
    return F.coalesce(F.try_to_date(F.substring(stamp, 1, 10), "yyyy-MM-dd"), fallback)
