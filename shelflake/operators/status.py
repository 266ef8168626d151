"""What became of each category of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_status(
    parsed_envelopes: DataFrame, categories: Sequence[str] | None = None
) -> DataFrame:
    """Per category: ``ok``, all and failed responses, listings, and a message.

    With ``categories``, exactly these are reported, also those without any response.
    Only a flag and a count leave each row, and they are summed before the shuffle,
    so a category with most of the responses costs no more than any other.
    """
    counted = parsed_envelopes.select(
        "category",
        F.col("best_sellers").isNotNull().alias("usable"),
        F.coalesce(F.size("best_sellers"), F.lit(0)).alias("listings"),
    )
    summed = counted.groupBy("category").agg(
        F.bool_or("usable").alias("ok"),
        F.count("*").alias("response_count"),
        F.count_if(~F.col("usable")).alias("failed_count"),
        F.sum(F.when(F.col("usable"), F.col("listings")).otherwise(0)).alias("row_count"),
    )
    return _reported(summed, categories)


def status_of_rows(rows: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """The same from the stored rows of responses and their listings, of which it reads two small columns.

    A response has one row that is its first listing or stands for none.
    """
    first = F.coalesce("position", F.lit(0)) == 0
    summed = rows.groupBy("category").agg(
        F.bool_or("usable").alias("ok"),
        F.count_if(first).alias("response_count"),
        F.count_if(~F.col("usable")).alias("failed_count"),
        F.count("position").alias("row_count"),
    )
    return _reported(summed, categories)


def _reported(summed: DataFrame, categories: Sequence[str] | None) -> DataFrame:
    if categories is not None:
        asked = summed.sparkSession.range(1).select(
            F.explode(F.array(*(F.lit(name) for name in categories))).alias("category")
        )
        summed = asked.join(summed, "category", "left").na.fill(
            {"ok": False, "response_count": 0, "failed_count": 0, "row_count": 0}
        )
    loaded = F.concat(F.col("row_count").cast("string"), F.lit(" listings for "), F.col("category"))
    failed = F.concat(F.lit("no usable response for "), F.col("category"))
    return summed.withColumn("message", F.when(F.col("ok"), loaded).otherwise(failed))


def status_lines(status: DataFrame) -> DataFrame:
    """The status as one JSON document per category."""
    return status.select("category", F.to_json(F.struct(*status.columns)).alias("status"))
