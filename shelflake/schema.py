"""Schemas, limits and the fixed values of the listing data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# These must match existing lakes, file drops and warehouse tables exactly.

FILE_PREFIX = "amazonbestsellers"

CATEGORIES = ("toys-and-games", "software", "kitchen", "appliances", "office-products")

# The business day runs on a fixed offset from UTC, without daylight saving.
OFFSET_HOURS = -5

# Symbol -> code, in the order in which the symbols are looked for.
CURRENCIES = {"$": "USD", "€": "EUR", "£": "GBP"}
UNKNOWN_CURRENCY = "Unknown"

WAREHOUSE_LIMITS = {
    "category": 255,
    "product_photo": 1000,
    "product_url": 1000,
    "currency": 10,
    "short_product_title": 500,
    "product_title": 1000,
    "asin": 50,
}
WAREHOUSE_REQUIRED = ("asin",)

# Name of the dropped column, and of the folder key used by the flat lake.
DROPPED_BY_LOAD = "rank_change_label"
FLAT_KEY = "snapshot_key"
LISTING_FIELDS = (
    "rank",
    "asin",
    "product_title",
    "product_price",
    "product_star_rating",
    "product_num_ratings",
    "product_url",
    "product_photo",
    "rank_change_label",
)

# Leaves are read as text so that numbers, text and null all coerce by one rule.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField(
                        "best_sellers",
                        T.ArrayType(
                            T.StructType(
                                [T.StructField(name, T.StringType()) for name in LISTING_FIELDS]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)

LAKE_SCHEMA = T.StructType(
    [
        T.StructField("rank", T.LongType()),
        T.StructField("asin", T.StringType()),
        T.StructField("product_title", T.StringType()),
        T.StructField("product_price", T.StringType()),
        T.StructField("product_star_rating", T.DoubleType()),
        T.StructField("product_num_ratings", T.LongType()),
        T.StructField("product_url", T.StringType()),
        T.StructField("product_photo", T.StringType()),
        T.StructField("rank_change_label", T.StringType()),
        T.StructField("fetch_timestamp", T.TimestampNTZType()),
    ]
)

PARTITION_COLUMNS = ("category", "year", "month", "day")

# Declared as text so that a zero-padded month stays '01'.
PARTITIONED_LAKE_SCHEMA = T.StructType(
    LAKE_SCHEMA.fields + [T.StructField(name, T.StringType()) for name in PARTITION_COLUMNS]
)

WAREHOUSE_SCHEMA = T.StructType(
    [
        T.StructField("product_num_ratings", T.IntegerType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("product_star_rating", T.DoubleType()),
        T.StructField("category", T.StringType()),
        T.StructField("product_photo", T.StringType()),
        T.StructField("product_url", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("short_product_title", T.StringType()),
        T.StructField("product_title", T.StringType()),
        T.StructField("asin", T.StringType()),
        T.StructField("fetch_timestamp", T.TimestampType()),
        T.StructField("product_price", T.DecimalType(10, 2)),
    ]
)

# --- end of fixed values ----------------------------------------------------

IDENTITY_COLUMN = "unique_id"
SNAPSHOT_DAY = "snapshot_day"
