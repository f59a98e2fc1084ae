"""Identity numbers that carry check digits: IMO ship numbers and Russian tax numbers (INN)."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The weights of the digits, from the left.
IMO_WEIGHTS = (7, 6, 5, 4, 3, 2)
INN_10_WEIGHTS = (2, 4, 10, 3, 5, 9, 4, 6, 8)
INN_12_WEIGHTS = ((7, 2, 4, 10, 3, 5, 9, 4, 6, 8), (3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8))


def _digit(digits: Column, place: int) -> Column:
    return F.substring(digits, place, 1).try_cast("int")


def _weighted(digits: Column, weights: Sequence[int]) -> Column:
    return sum((_digit(digits, i + 1) * w for i, w in enumerate(weights)), F.lit(0))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value worked out once for however many places that name it: expressions are copied into each."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def digits_of(number: Column) -> Column:
    """The number without a leading name of its kind, blanks, dashes and dots; null if anything else is left in it."""
    bare = F.regexp_replace(F.regexp_replace(number, r"(?i)^\s*(?:imo|inn)\b", ""), r"[\s.\-]+", "")
    return _once(bare, lambda b: F.when(b.rlike(r"\A[0-9]+\z"), b))


def _imo(digits: Column) -> Column:
    return F.coalesce((F.length(digits) == 7) & (_weighted(digits, IMO_WEIGHTS) % 10 == _digit(digits, 7)), F.lit(False))


def _inn(digits: Column) -> Column:
    check = lambda weights: _weighted(digits, weights) % 11 % 10 == _digit(digits, len(weights) + 1)
    ten = (F.length(digits) == 10) & check(INN_10_WEIGHTS)
    twelve = (F.length(digits) == 12) & check(INN_12_WEIGHTS[0]) & check(INN_12_WEIGHTS[1])
    return F.coalesce(ten | twelve, F.lit(False))


def is_imo(number: Column) -> Column:
    """Seven digits, the last one the weighted sum of the others by ten."""
    return _once(digits_of(number), _imo)


def is_inn(number: Column) -> Column:
    """Ten digits with one check digit, or twelve with two: weighted sums by eleven, then by ten."""
    return _once(digits_of(number), _inn)


def identify(kind: Column, number: Column) -> Column:
    """(kind, number, verified): the kind as given, or told by the check digits where none with check digits is given.

    ``verified`` is null for kinds without check digits. A bare number of seven digits is
    no ship number unless it is called one: one in ten passes by chance.
    """
    named_imo = F.coalesce(number.rlike(r"(?i)^\s*imo\b"), F.lit(False))

    def tell(passes: Column) -> Column:
        told = F.when(kind.isin("IMO", "INN"), kind).when(named_imo, "IMO").when(passes["inn"], "INN").otherwise(kind)
        return _once(told, lambda t: F.struct(
            t.alias("kind"), number.alias("number"), F.when(t == "IMO", passes["imo"]).when(t == "INN", passes["inn"]).alias("verified")))

    passes = _once(digits_of(number), lambda d: F.struct(_imo(d).alias("imo"), _inn(d).alias("inn")))
    return _once(passes, tell)
