"""Flat drops -> organized tree."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import literal_path
from ..operators import matched, not_organized, rows_of_files, unmatched
from ..schema import FILE_PREFIX, LAKE_SCHEMA
from ..sinks.organized import write_organized, write_unmatched
from ..sources import drop_files, organized_keys
from ..sources.flat import with_uri
from ..sources.listing import kept
from ..sources.organized import ORGANIZED_KEYS, closed_before, record_organized


@dataclass(frozen=True)
class OrganizeResult:
    organized: int
    skipped: int
    unmatched: int


def _rows_behind(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Rows of the given drop files, without opening any other file.

    The files are read by name. Their names reach the driver, where Spark's own index of
    the scan holds them anyway; what was organized before is not among them.
    """
    names = [literal_path(row.file_path) for row in files.select("file_path").toLocalIterator()]
    scan = with_uri(spark.read.schema(LAKE_SCHEMA).parquet(*names))
    return rows_of_files(scan, files)


def _counted(files: DataFrame, existing: DataFrame) -> OrganizeResult:
    known = existing.withColumn("known", F.lit(True))
    drops = files.select(*ORGANIZED_KEYS).distinct().join(known, list(ORGANIZED_KEYS), "left")
    named = F.col("category") != ""
    counts = drops.agg(
        F.count_if(named & F.col("known").isNull()).alias("organized"),
        F.count_if(F.col("known").isNotNull()).alias("skipped"),
        F.count_if(~named).alias("unmatched"),
    )
    return OrganizeResult(**counts.first().asDict())


def organize(
    spark: SparkSession,
    flat_root: str,
    target_root: str,
    *,
    rejects_root: str | None = None,
    prefix: str = FILE_PREFIX,
    all_days: bool = False,
) -> OrganizeResult:
    """Copy each new drop into its own folder under its category.

    A drop that was organized before is skipped, also one without rows. What was organized is read from
    the tree's manifest, so a run does not list the tree. A drop whose name tells no category goes to
    ``rejects_root`` (replacing its earlier copy there) or, without one, stays where
    it is. The number of Spark jobs does not depend on the number of drops. Sources
    are kept; to retire them use the streaming form.

    Drops of closed days (:func:`close_days`), told by their names, are neither listed nor counted, unless
    ``all_days`` asks for them; drops whose name tells no day always are.
    """
    since = None if all_days else closed_before(spark, target_root)
    # Both listings are used several times; they hold a line per file, not per row.
    with (
        kept(drop_files(spark, flat_root, prefix, since)) as files,
        kept(organized_keys(spark, target_root, matched(files))) as existing,
    ):
        result = _counted(files, existing)
        if result.organized:
            new_files = not_organized(matched(files), existing)
            write_organized(_rows_behind(spark, new_files), target_root)
            # A run that ends before this line is done again: it replaces its own folders.
            record_organized(new_files, target_root)
        if result.unmatched and rejects_root is not None:
            rows = _rows_behind(spark, unmatched(files))
            write_unmatched(rows, rejects_root)
        return result
