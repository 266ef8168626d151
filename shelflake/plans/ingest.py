"""Responses of one run -> lake."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import business_time
from ..operators import parsed, responses_and_listings, status_of_rows, typed_listings
from ..schema import OFFSET_HOURS
from ..session import passing_path
from ..sinks.lake import write_partitioned


def ingest(
    envelopes: DataFrame,
    root: str,
    *,
    as_of: datetime | None = None,
    offset_hours: int = OFFSET_HOURS,
    categories: Sequence[str] | None = None,
    write: Callable[[DataFrame, str], None] = write_partitioned,
) -> DataFrame:
    """Write all usable responses of a run and return the status of each category.

    All categories go through one plan and one write. An unusable response does not
    stop the others; it shows in the status. Pass ``write=write_flat`` for the flat
    layout. A run repeated on the same day replaces its own category-days.

    Each response is parsed once: its listings are stored typed in the shared folder, with a row for each
    response that has none. The lake is written from the stored rows and the status is counted from them,
    so a task that was repeated is not counted twice. The status is there when this returns.
    """
    spark = envelopes.sparkSession
    rows = responses_and_listings(parsed(envelopes, categories))
    typed = typed_listings(rows, business_time(as_of, offset_hours), "usable", "position")
    with passing_path(spark, "ingest") as path:
        typed.write.parquet(path)
        stored = spark.read.schema(typed.schema).parquet(path)
        write(stored.where(F.col("position").isNotNull()).drop("usable", "position"), root)
        # A row for each category.
        status = status_of_rows(stored, categories)
        return spark.createDataFrame(status.collect(), status.schema)
