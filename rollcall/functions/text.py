"""Text expressions."""

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall import fixed_values as fv

def no_strings() -> Column:
    return F.array().cast("array<string>")


def strip(c: Column) -> Column:
    """Drop surrounding whitespace of any script, not only the ASCII blank."""
    return F.btrim(c, F.lit(fv.WHITESPACE))


def safe_text(c: Column) -> Column:
    """Stripped text, '' when missing."""
    return F.coalesce(strip(c), F.lit(""))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def not_empty(c: Column) -> Column:
    """True only for a present, non-empty string."""
    return F.length(c) > 0


def strings_or_none(arr: Column) -> Column:
    """An array column with a missing array read as an empty one."""
    return F.coalesce(arr, no_strings())


def kept(arr: Column) -> Column:
    """The non-empty strings of an array, in order."""
    return F.filter(strings_or_none(arr), not_empty)


def join_items(arr: Column, sep: str = fv.ITEM_SEPARATOR) -> Column:
    return or_empty(F.array_join(arr, sep))


def join_parts(*parts: Column, sep: str = fv.PART_SEPARATOR) -> Column:
    """Join the non-empty parts; '' when there is none."""
    return F.concat_ws(sep, *[F.nullif(p, F.lit("")) for p in parts])


def lookup(code: Column, table: Mapping[str, str], miss_prefix: str) -> Column:
    """Decode through a small constant map; a miss keeps the code, named."""
    pairs = ", ".join(f"'{k}', '{v}'" for k, v in table.items())
    known = F.try_element_at(F.expr(f"map({pairs})"), code)
    return F.coalesce(known, F.concat(F.lit(miss_prefix), F.coalesce(code, F.lit("None"))))


def contains_any(lowered: Column, words: Sequence[str]) -> Column:
    """True if one word occurs; a word holding another listed word adds nothing."""
    telling = [w for w in words if not any(o != w and o in w for o in words)]
    return reduce(or_, [lowered.contains(w) for w in telling])


def contains_all(lowered: Column, words: Sequence[str]) -> Column:
    return reduce(and_, [lowered.contains(w) for w in words])


def null_tokens(c: Column) -> Column:
    """Null where the text is one of the tokens a CSV read takes as missing."""
    return F.when(~c.isin(*fv.NULL_TOKENS), c)


def readable_size(n: Column) -> Column:
    """'0B', '1.2KB', ...: one decimal, ties to the even digit."""
    last = len(fv.SIZE_UNITS) - 1
    text = None
    for power, unit in enumerate(fv.SIZE_UNITS):
        shown = F.format_string(
            "%.1f" + unit, F.bround(n.cast("double") / F.lit(float(1024**power)), 1)
        )
        if power == 0:
            text = F.when(n == 0, F.lit("0B")).when(n < 1024, shown)
        elif power < last:
            text = text.when(n < 1024 ** (power + 1), shown)
        else:
            text = text.when(n.isNotNull(), shown)
    return text


def preview(c: Column) -> Column:
    cut = F.concat(F.left(c, F.lit(fv.PREVIEW_CHARS)), F.lit("..."))
    return F.when(F.length(c) > fv.PREVIEW_CHARS, cut).otherwise(c)


def line_count(c: Column) -> Column:
    """Lines as str.splitlines() gives them: a closing line end opens no line."""
    ends = F.regexp_count(c, F.lit(fv.LINE_END))
    open_tail = (F.length(c) > 0) & ~F.right(c, F.lit(1)).rlike(f"^(?:{fv.LINE_END})\\z")
    return (ends + open_tail.cast("int")).cast("long")


def byte_count(c: Column) -> Column:
    return F.octet_length(c).cast("long")


def strip_fences(c: Column) -> Column:
    """Take the code fences off an answer and strip it."""
    opened = F.regexp_replace(c, r"(?U)```csv\s*\n?", "")
    closed = F.regexp_replace(opened, r"(?U)```\s*\z", "")
    return strip(closed)
