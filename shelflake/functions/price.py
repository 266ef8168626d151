"""Currency and amount from a displayed price."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import CURRENCIES, UNKNOWN_CURRENCY


def currency_of(price: Column) -> Column:
    """Code of the first known symbol that occurs anywhere in the text."""
    hits = [F.when(price.contains(symbol), F.lit(code)) for symbol, code in CURRENCIES.items()]
    return F.coalesce(*hits, F.lit(UNKNOWN_CURRENCY))


def cleaned_price(price: Column) -> Column:
    """Digits of the price, with the last dot (only) as decimal point.

    The dots before the last one are removed with a plain replace on the part before
    the fraction. That is linear in the text, unlike a look-ahead for a later dot.
    """
    kept = F.regexp_replace(price, "[^0-9.]", "")
    fraction = F.substring_index(kept, ".", -1)
    whole = F.substring(kept, F.lit(1), F.length(kept) - F.length(fraction))
    joined = F.concat(F.replace(whole, F.lit("."), F.lit("")), F.lit("."), fraction)
    return F.when(kept.contains("."), joined).otherwise(kept)
