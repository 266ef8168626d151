"""Writing the lake.

Both layouts overwrite exactly the category-days present in the data, so repeating a
run replaces its own output and leaves the rest alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import day_key, lake_keys
from ..partitions import NO_VALUE, add_partitions
from ..schema import FILE_PREFIX, FLAT_KEY, LAKE_SCHEMA, PARTITION_COLUMNS


def with_lake_keys(listings: DataFrame) -> DataFrame:
    return listings.withColumns(lake_keys(F.col("fetch_timestamp")))


def _overwrite_keys(rows: DataFrame, root: str, keys: tuple[str, ...], rebalance: bool) -> None:
    # Rebalancing gathers a key's rows into files of the advisory size. Unlike a plain
    # repartition by key it also splits a key that is too large for one task.
    if rebalance:
        rows = rows.hint("rebalance", *keys)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(root)
    )


def write_partitioned(
    listings: DataFrame, root: str, *, rebalance: bool = True, table: str | None = None
) -> None:
    """``category=/year=/month=/day=`` from typed listings plus ``category``.

    Without ``rebalance`` nothing is shuffled: good where each task already holds few
    category-days, otherwise every task leaves a small file in each of them.

    The category-days that were written become partitions of ``table``, if one is named. They are gathered
    while the rows pass, as a set, so that a repeated task does not matter; nothing is listed.
    """
    rows = with_lake_keys(listings).select(*LAKE_SCHEMA.names, *PARTITION_COLUMNS)
    if table is None:
        _overwrite_keys(rows, root, PARTITION_COLUMNS, rebalance)
        return
    written = Observation()
    named = [F.coalesce(F.nullif(F.col(n), F.lit("")), F.lit(NO_VALUE)).alias(n) for n in PARTITION_COLUMNS]
    observed = rows.observe(written, F.collect_set(F.struct(*named)).alias("keys"))
    _overwrite_keys(observed, root, PARTITION_COLUMNS, rebalance)
    keys = [tuple(key) for key in written.get["keys"]]
    add_partitions(listings.sparkSession, table, PARTITION_COLUMNS, keys)
    listings.sparkSession.catalog.refreshTable(table)


def write_flat(
    listings: DataFrame, root: str, *, prefix: str = FILE_PREFIX, rebalance: bool = True
) -> None:
    """One folder per category and day, named by the drop key, all in one place."""
    key = F.concat_ws("_", F.lit(prefix), "category", day_key(F.col("fetch_timestamp")))
    rows = listings.withColumn(FLAT_KEY, key).select(*LAKE_SCHEMA.names, FLAT_KEY)
    _overwrite_keys(rows, root, (FLAT_KEY,), rebalance)
