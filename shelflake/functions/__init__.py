"""Column expressions. All are built-in Spark functions and stay in code generation."""

from .clock import business_day, business_time, day_key, lake_keys
from .numeric import to_double, to_long
from .paths import category_of, decoded, file_key, file_name, without_extension
from .price import cleaned_price, currency_of
from .title import short_title

__all__ = [
    "business_day",
    "business_time",
    "category_of",
    "cleaned_price",
    "currency_of",
    "day_key",
    "decoded",
    "file_key",
    "file_name",
    "lake_keys",
    "short_title",
    "to_double",
    "to_long",
    "without_extension",
]
