"""From response envelopes to typed listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import to_double, to_long
from ..schema import ENVELOPE_SCHEMA, LAKE_SCHEMA
from .losses import LOSSES, loss_bits


def parsed(envelopes: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """``(category, best_sellers)``; the list is NULL where the response is not usable.

    That covers a missing body, text that is not JSON and a document without the list.
    An empty list is usable: it just has no listings.
    """
    if categories is not None:
        envelopes = envelopes.where(F.col("category").isin(*categories))
    document = F.from_json("body", ENVELOPE_SCHEMA)
    return envelopes.select("category", document["data"]["best_sellers"].alias("best_sellers"))


def listings_of(parsed_envelopes: DataFrame) -> DataFrame:
    """One row per listing, all values still text.

    The outer form plus a filter on the position drops unusable and empty lists after
    the fact. The inner form makes the optimizer test the list before it is exploded,
    and with that parse every document twice.
    """
    return (
        parsed_envelopes.select(
            "category", F.posexplode_outer("best_sellers").alias("position", "listing")
        )
        .where(F.col("position").isNotNull())
        .select("category", "listing.*")
    )


def responses_and_listings(parsed_envelopes: DataFrame) -> DataFrame:
    """A row for each listing, and one for each response that has none, all values still text.

    ``position`` counts the listings of a response from 0 and is NULL where there are none; ``usable`` tells
    a response without a list from one with an empty one. So the rows tell all about the responses.
    """
    marked = parsed_envelopes.select("category", "best_sellers", F.col("best_sellers").isNotNull().alias("usable"))
    exploded = marked.select("category", "usable", F.posexplode_outer("best_sellers").alias("position", "listing"))
    return exploded.select("category", "usable", "position", "listing.*")


def typed_listings(
    listings: DataFrame, fetched_at: Column | None = None, *more: Column | str, losses: bool = False
) -> DataFrame:
    """The lake's columns plus ``category``, and more if asked for.

    ``fetched_at`` stamps the rows of a fresh fetch; without it the listings must
    already carry ``fetch_timestamp``. A missing price stays NULL. With ``losses`` a row also has the
    bits of the numbers that its text did not give.
    """
    if fetched_at is not None:
        listings = listings.withColumn("fetch_timestamp", fetched_at)
    numbers = {
        "rank": to_long(F.col("rank")),
        "product_num_ratings": to_long(F.col("product_num_ratings")),
        "product_star_rating": to_double(F.col("product_star_rating")),
    }
    if losses:
        bits = loss_bits({name: F.col(name) for name in numbers}, numbers)
        listings, more = listings.withColumn(LOSSES, bits), (*more, LOSSES)
    coerced = listings.withColumns(numbers | {"product_price": F.col("product_price").cast("string")})
    lake_columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in LAKE_SCHEMA]
    return coerced.select(*lake_columns, "category", *more)
