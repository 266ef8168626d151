"""Which values a cast has lost: a bit for each column whose text or number was there and is NULL now."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The columns that are cast, by the number of their bit.
LOSS_COLUMNS = ("product_num_ratings", "rank", "product_star_rating", "product_price")
LOSSES = "losses"


def loss_bits(given: Mapping[str, Column], kept: Mapping[str, Column]) -> Column:
    """The bits of the columns in ``kept``, from what they were and what they are."""
    bits = [
        F.when(given[name].isNotNull() & kept[name].isNull(), F.lit(1 << n)).otherwise(F.lit(0))
        for n, name in enumerate(LOSS_COLUMNS)
        if name in kept
    ]
    return reduce(Column.bitwiseOR, bits)


def _lost(name: str) -> Column:
    return F.col(LOSSES).bitwiseAND(1 << LOSS_COLUMNS.index(name)) != 0


def loss_counts() -> list[Column]:
    """The number of lost values of each column, as aggregates over rows with their bits."""
    return [F.count_if(_lost(name)).alias(f"lost_{name}") for name in LOSS_COLUMNS]


def lost_values(rows: DataFrame, *keys: str) -> DataFrame:
    """A row for each key and column: the number of values lost and of rows. One pass."""
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), *loss_counts())
    pairs = ", ".join(f"'{name}', lost_{name}" for name in LOSS_COLUMNS)
    unfolded = f"stack({len(LOSS_COLUMNS)}, {pairs}) AS (column_name, n_lost)"
    return counted.selectExpr(*keys, "n_rows", unfolded)
