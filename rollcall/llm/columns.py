"""Column helpers."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The blanks that part words: space, \t, \n, \v, \f, \r.
BLANKS = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def blank_split(text: Column) -> Column:
    """The words between blanks."""
    return F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")
