"""A listing feed derived from the ``part`` table.

Three daily snapshots of every part, with the irregular prices, titles and numbers a
real feed has. Every value comes from its own row, and nothing depends on how many rows
share a key; the rows of a large table are dealt out to tasks, by their place alone.
``FIXTURES.md`` describes each column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import LISTING_FIELDS

SNAPSHOTS = (1, 2, 3)

#: A task makes the listings of about so many parts. A part becomes a dozen rows or some kilobytes of JSON, so
#: the splits of the file, which go by its own size, hold far too many.
PARTS_PER_TASK = 20_000

# Bodies no listing can be read from, and one that is fine but has no listings.
ODD_BODIES = (
    "not json",
    '{"data":{}}',
    None,
    '{"data":{"best_sellers":[]}}',
    '{"data":{"best_sellers":null}}',
)


def _choose(selector: Column, *cases: Column | str | None) -> Column:
    """``cases[selector]``, for a selector that counts from 0."""
    values = [c if isinstance(c, Column) else F.lit(c).cast("string") for c in cases]
    return F.elt((selector + 1).cast("int"), *values)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table, dealt out to tasks by its number of rows.

    The number is in the files' footers. Rows go by their place in the table, which does not change when a
    task is repeated, and not by a key, which many may share.
    """
    rows = spark.read.parquet(f"{sf_dir}/part.parquet")
    tasks = -(-rows.count() // PARTS_PER_TASK)
    if tasks <= 1:
        return rows
    return rows.withColumn("__place", F.monotonically_increasing_id()).repartition(tasks, "__place").drop("__place")


def _listing_columns(k: Column, s: Column) -> dict[str, Column]:
    name, brand, kind, size = (F.col(f"p_{c}") for c in ("name", "brand", "type", "size"))
    money = F.col("p_retailprice").cast("decimal(10,2)").cast("string")
    key_text = k.cast("string")
    rating = F.concat(
        F.floor((size % 50) / 10).cast("string"), F.lit("."), (size % 10).cast("string")
    )
    return {
        "rank": F.when(k % 97 == 0, "n/a").otherwise(
            (1 + (k * 7919 + s * 104729) % 100003).cast("string")
        ),
        "asin": F.concat(
            F.lit("B"), F.lpad(key_text, 9, "0"), F.substring(key_text, 10, 10)
        ),
        "product_title": _choose(
            k % 5,
            F.concat(name, F.lit(", "), brand, F.lit(" | "), kind),
            F.concat(name, F.lit(" | "), brand),
            name,
            F.concat(name, F.lit("|"), brand, F.lit(", "), kind),
            None,
        ),
        "product_price": _choose(
            k % 9,
            F.concat(F.lit("$"), money),
            F.concat(F.lit("$1,"), money),
            F.concat(F.lit("€"), money),
            F.concat(F.lit("£"), money),
            "None",
            None,
            F.concat(F.lit("€1."), size.cast("string"), F.lit(",99")),
            F.concat(F.lit("$12.99 - $"), money),
            "$123456789.00",
        ),
        "product_star_rating": F.when(k % 89 == 0, "bad").when(k % 83 == 0, "NaN").otherwise(rating),
        "product_num_ratings": F.when(k % 79 == 0, "1,234")
        .when(k % 73 == 0, "1e3")
        .otherwise(((k * 31 + s) % 5000).cast("string")),
        "product_url": F.concat(F.lit("https://example.com/dp/"), key_text),
        "product_photo": F.concat(F.lit("https://example.com/img/"), key_text, F.lit(".jpg")),
        "rank_change_label": F.lit(None).cast("string"),
    }


def _snapshot_time(snap: Column) -> Column:
    noon = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")
    return noon + F.make_dt_interval(days=snap - 1)


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``category``, ``snap``, the nine listing fields as text, and ``fetch_timestamp``."""
    rows = parts(spark, sf_dir).withColumn("snap", F.explode(F.array(*map(F.lit, SNAPSHOTS))))
    listing = _listing_columns(F.col("p_partkey"), F.col("snap"))
    return rows.select(
        F.lower("p_type").alias("category"),
        "snap",
        *(listing[name].alias(name) for name in LISTING_FIELDS),
        _snapshot_time(F.col("snap")).alias("fetch_timestamp"),
    )


def flawed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with missing ids and over-long titles here and there."""
    k = F.regexp_extract("product_url", "[0-9]+$", 0).cast("bigint")
    return raw_feed(spark, sf_dir).withColumns(
        {
            "asin": F.when(k % 101 != 0, F.col("asin")),
            "product_title": F.when(k % 103 == 0, F.repeat(F.lit("long title "), 100)).otherwise(
                F.col("product_title")
            ),
        }
    )


def raw_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses whose listings are together the whole feed, plus as many odd ones.

    Each part gives one response with its three snapshots' listings and one odd
    response, so a document's size does not depend on the data.
    """
    k = F.col("p_partkey")

    def listing(s: int) -> Column:
        columns = _listing_columns(k, F.lit(s))
        return F.struct(*(columns[name].alias(name) for name in LISTING_FIELDS))

    best_sellers = F.array(*(listing(s) for s in SNAPSHOTS))
    document = F.struct(F.struct(best_sellers.alias("best_sellers")).alias("data"))
    good = F.to_json(document, {"ignoreNullFields": "false"})
    odd = _choose(k % len(ODD_BODIES), *ODD_BODIES)
    return parts(spark, sf_dir).select(
        F.lower("p_type").alias("category"), F.explode(F.array(good, odd)).alias("body")
    )
