"""The warehouse table's constraints as a row filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import WAREHOUSE_LIMITS, WAREHOUSE_REQUIRED

VIOLATIONS = "violations"


def with_violations(rows: DataFrame) -> DataFrame:
    """Add the broken constraints of each row, in column order; empty text if none."""
    missing = [
        F.when(F.col(name).isNull(), F.lit(f"{name} is missing")) for name in WAREHOUSE_REQUIRED
    ]
    too_long = [
        F.when(F.char_length(name) > limit, F.lit(f"{name} is longer than {limit}"))
        for name, limit in WAREHOUSE_LIMITS.items()
    ]
    return rows.withColumn(VIOLATIONS, F.concat_ws("; ", *missing, *too_long))


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(VIOLATIONS) != "")
