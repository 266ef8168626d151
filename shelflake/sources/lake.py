"""The lake partitioned by category, year, month and day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import any_match, literal_path, matches, path_exists, same_place as _same_place
from ..functions import business_day
from ..schema import OFFSET_HOURS, PARTITION_COLUMNS, PARTITIONED_LAKE_SCHEMA
from ..partitions import NO_VALUE, add_partitions, escaped, literal
from .missing import empty_frame


def read_lake(spark: SparkSession, root: str) -> DataFrame:
    """Every day of the lake. Lists the whole lake; for one day use :func:`read_day`."""
    return spark.read.schema(PARTITIONED_LAKE_SCHEMA).parquet(root)


def read_day(
    spark: SparkSession,
    root: str,
    *,
    day: date | None = None,
    as_of: datetime | None = None,
    offset_hours: int = OFFSET_HOURS,
    categories: Sequence[str] | None = None,
) -> DataFrame:
    """One day of all (or the given) categories; no rows if there is no such day.

    The day is part of the path, so only that day's folders are listed, however long
    the history is. ``basePath`` keeps the partition columns.
    """
    day = day or business_day(as_of, offset_hours)
    path = f"{root}/category=*/year={day:%Y}/month={day:%m}/day={day:%d}"
    if any_match(spark, path):
        reader = spark.read.schema(PARTITIONED_LAKE_SCHEMA).option("basePath", root)
        found = reader.parquet(path)
    else:
        found = empty_frame(spark, PARTITIONED_LAKE_SCHEMA)
    return found if categories is None else found.where(F.col("category").isin(*categories))


def categories_of_day(spark: SparkSession, root: str, day: date) -> set[str]:
    """The categories that have a folder for a day, with or without rows."""
    found = matches(spark, f"{root}/category=*/year={day:%Y}/month={day:%m}/day={day:%d}")
    return {category_day(path)[1] for path in found}


def category_day(folder: str) -> tuple[str, str]:
    """Day as ``yyyymmdd`` and category of a category-day's folder."""
    category, *day = (unquote(part.partition("=")[2]) for part in folder.rsplit("/", 4)[1:])
    return "".join(day), category


def read_folders(spark: SparkSession, root: str, folders: Sequence[str]) -> DataFrame:
    """Some category-days of the lake, by their folders. Folders that are gone have no rows."""
    there = [literal_path(folder) for folder in folders if path_exists(spark, folder)]
    if not there:
        return empty_frame(spark, PARTITIONED_LAKE_SCHEMA)
    return spark.read.schema(PARTITIONED_LAKE_SCHEMA).option("basePath", root).parquet(*there)


def read_category_days(
    spark: SparkSession, root: str, keys: Sequence[tuple[str, str, str, str]]
) -> DataFrame:
    """Some category-days of the lake, by the values of their partition columns. All must be there."""
    if not keys:
        return empty_frame(spark, PARTITIONED_LAKE_SCHEMA)
    folders = [
        literal_path("/".join([root, *(f"{n}={escaped(v)}" for n, v in zip(PARTITION_COLUMNS, key))])) for key in keys
    ]
    return spark.read.schema(PARTITIONED_LAKE_SCHEMA).option("basePath", root).parquet(*folders)


def register_lake(spark: SparkSession, table: str, root: str, *, find: bool = True) -> None:
    """Make the lake a catalog table for ad-hoc SQL.

    The catalog prunes partitions before files are listed. With ``find`` the whole lake is listed for
    partitions; without it the table has those that are added by ``add_days`` or by a write that names the
    table. Partitions that were written around the catalog become visible with ``refresh_lake``.
    """
    if spark.catalog.tableExists(table):
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
        known = described.first()["data_type"]
        if not _same_place(spark, known, root):
            raise ValueError(f"{table} is registered at {known}, not at {root}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in PARTITIONED_LAKE_SCHEMA)
    keys = ", ".join(PARTITION_COLUMNS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({keys}) LOCATION {literal(root)}"
    )
    if find and path_exists(spark, root):
        refresh_lake(spark, table)


def add_days(spark: SparkSession, table: str, days: DataFrame) -> None:
    """Make category-days (the partition columns) that were just written visible, and list nothing
    else.
    """
    named = [F.coalesce(F.nullif(F.col(n), F.lit("")), F.lit(NO_VALUE)).alias(n) for n in PARTITION_COLUMNS]
    found = days.select(*named).distinct().toLocalIterator()
    add_partitions(spark, table, PARTITION_COLUMNS, (tuple(row) for row in found))


def refresh_lake(spark: SparkSession, table: str) -> None:
    """Find partitions that other writers added or removed."""
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
