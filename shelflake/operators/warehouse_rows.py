"""One snapshot of listings in warehouse form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cleaned_price, currency_of, short_title
from ..schema import DROPPED_BY_LOAD, WAREHOUSE_SCHEMA
from .losses import LOSS_COLUMNS, loss_bits


def warehouse_rows(listings: DataFrame, *more: Column) -> DataFrame:
    """The twelve loaded columns, in table order and with table types, and more if asked for.

    Currency and amount both come from the displayed price. Values that do not fit
    their type become NULL and never wrap around.
    """
    price = F.col("product_price")
    derived = listings.drop(DROPPED_BY_LOAD).withColumns(
        {
            "currency": currency_of(price),
            "short_product_title": short_title(F.col("product_title")),
            "product_price": cleaned_price(price),
        }
    )
    return derived.select(*(_as_stored(f) for f in WAREHOUSE_SCHEMA), *more)


def warehouse_losses() -> Column:
    """The bits of what :func:`warehouse_rows` loses, to be asked for with it."""
    fields = [f for f in WAREHOUSE_SCHEMA if f.name in LOSS_COLUMNS]
    return loss_bits({f.name: F.col(f.name) for f in fields}, {f.name: _as_stored(f) for f in fields})


def _as_stored(field: T.StructField) -> Column:
    """The column in its table type. Zone-less times are UTC, whatever zone the session has."""
    value = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType):
        value = F.convert_timezone(F.lit("UTC"), F.current_timezone(), value)
    return value.try_cast(field.dataType).alias(field.name)
