"""Text to number, where anything that is not a number becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A cast follows Java, which also takes '12d', '1.5f' and hexadecimal floats. So the
# number is first picked by its grammar; other texts give '', which no cast accepts.
_NUMBER = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$"
_INFINITY = r"(?i)^\s*([+-]?inf(?:inity)?)\s*$"


def _double_as_spelled(text: Column, pattern: str) -> Column:
    return F.regexp_extract(text, pattern, 1).try_cast("double")


def to_double(text: Column) -> Column:
    """Double. NaN is missing, and infinity is one only where it is spelled out."""
    parsed = _double_as_spelled(text, _NUMBER)
    for overflow in (float("inf"), float("-inf")):
        parsed = F.nullif(parsed, F.lit(overflow))
    return F.coalesce(parsed, _double_as_spelled(text, _INFINITY))


def to_long(text: Column) -> Column:
    """Exact long: whole numbers in any notation; fractions and overflow give NULL.

    Almost every value is plain digits and done with the first cast. The decimal has
    room for each long and for more decimals than a double can tell apart.
    """
    number = F.regexp_extract(text, _NUMBER, 1)
    exact = number.try_cast("decimal(38,18)")
    # A fraction too small for the decimal is still one for the double, and if not, by its digits.
    as_double = number.try_cast("double")
    whole = (exact % 1 == 0) & (F.floor(as_double) == as_double)
    whole &= (exact != 0) | F.rlike(number, F.lit(r"^[+-]?[0.]+(?:[eE].*)?$"))
    return F.coalesce(number.try_cast("bigint"), F.when(whole, exact.try_cast("bigint")))
