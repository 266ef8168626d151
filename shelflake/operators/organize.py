"""Which drops go where."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import FILE_PREFIX, LAKE_SCHEMA
from ..sources.flat import FILE_URI, with_lineage
from ..sources.organized import ORGANIZED_KEYS


def matched(drops: DataFrame) -> DataFrame:
    """Drops (or their rows) whose name tells a category."""
    return drops.where(F.col("category") != "")


def unmatched(drops: DataFrame) -> DataFrame:
    return drops.where(F.col("category") == "")


def files_behind(rows: DataFrame, prefix: str = FILE_PREFIX) -> DataFrame:
    """The distinct files behind some rows, with their lineage.

    Each task first reduces its rows to a handful of URIs; names are taken apart once
    per file and not once per row.
    """
    return with_lineage(rows.select(FILE_URI).distinct(), prefix)


def distinct_drops(files: DataFrame) -> DataFrame:
    """The distinct drops behind some files, with their destination."""
    return (
        files.select(*ORGANIZED_KEYS)
        .distinct()
        .withColumn("destination", F.concat_ws("/", *ORGANIZED_KEYS))
    )


def not_organized(drops: DataFrame, existing: DataFrame) -> DataFrame:
    """Drops without a folder in the organized tree yet."""
    return drops.join(existing, list(ORGANIZED_KEYS), "left_anti")


def already_organized(drops: DataFrame, existing: DataFrame) -> DataFrame:
    return drops.join(existing, list(ORGANIZED_KEYS), "left_semi")


def rows_of_files(rows: DataFrame, files: DataFrame) -> DataFrame:
    """The rows of the given files only, with the destination of each.

    Spark broadcasts the files while its statistics call them small, and then no row is
    shuffled. Otherwise it joins by file and splits the files that are too large for a task.
    """
    destinations = files.select(FILE_URI, *ORGANIZED_KEYS)
    return rows.join(destinations, FILE_URI).select(*LAKE_SCHEMA.names, *ORGANIZED_KEYS)
