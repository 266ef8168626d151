"""The organized tree: ``category=<category>/file_key=<key>/``."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import literal_path, mark, names_in, path_exists, remove_folder
from ..functions import decoded
from ..generations import newest_generation, write_generation
from ..partitions import escaped
from ..schema import LAKE_SCHEMA
from .missing import empty_frame, matches_or_empty, read_or_empty

ORGANIZED_KEYS = ("category", "file_key")
KEY_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in ORGANIZED_KEYS])
ORGANIZED_SCHEMA = T.StructType(LAKE_SCHEMA.fields + KEY_SCHEMA.fields)


def read_organized(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, ORGANIZED_SCHEMA, root)


def read_drops(spark: SparkSession, root: str, drops: DataFrame) -> DataFrame:
    """The rows of some drops, without listing the tree. Drops without rows have no folder.

    As many folders as drops are asked for, such as those of a batch.
    """
    folders = [
        f"{root}/category={escaped(row.category)}/file_key={escaped(row.file_key)}"
        for row in drops.select(*ORGANIZED_KEYS).toLocalIterator()
    ]
    there = [literal_path(folder) for folder in folders if path_exists(spark, folder)]
    if not there:
        return empty_frame(spark, ORGANIZED_SCHEMA)
    return spark.read.schema(ORGANIZED_SCHEMA).option("basePath", root).parquet(*there)


def manifest(root: str) -> str:
    """Where the tree's own list of organized drops is kept. Readers of the tree pass it over.

    It holds a generation of keys in buckets by their hash, and beside it the keys of each run since. The
    name of a generation ends in its number of buckets, which grows with the keys, so that a bucket does
    not.
    """
    return f"{root}/_organized"


#: Keys that a bucket holds, more or less.
KEYS_PER_BUCKET = 10_000


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*ORGANIZED_KEYS), F.lit(buckets)).alias("bucket")


def _of_runs(spark: SparkSession, root: str) -> list[str]:
    """Where the keys of the runs since the last compaction are."""
    place = f"{manifest(root)}/runs"
    early = [manifest(root)] if any(n.endswith(".parquet") for n in names_in(spark, manifest(root))) else []
    return early + [f"{place}/{name}" for name in names_in(spark, place) if not name.startswith((".", "_"))]


def _read_keys(spark: SparkSession, places: Sequence[str]) -> DataFrame:
    if not places:
        return empty_frame(spark, KEY_SCHEMA)
    return spark.read.schema(KEY_SCHEMA).parquet(*(f"{place}/*.parquet" for place in places))


def _ensured(spark: SparkSession, root: str) -> bool:
    """Whether there is a manifest. A tree that other means have filled is listed once for it."""
    if not path_exists(spark, root):
        return False
    if not any(name != "closed" for name in names_in(spark, manifest(root))):
        record_organized(listed_keys(spark, root), root)
    return True


def _in_buckets(spark: SparkSession, root: str, drops: DataFrame | None) -> DataFrame:
    """The keys of the generation in use, of the buckets that some drops fall into only."""
    folder = newest_generation(spark, manifest(root))
    if folder is None:
        return empty_frame(spark, KEY_SCHEMA)
    there = {name for name in names_in(spark, folder) if name.startswith("bucket=")}
    if drops is not None:
        number = _bucket(int(folder.rpartition("-")[2]))
        there &= {f"bucket={row.bucket}" for row in drops.select(number).distinct().collect()}
    if not there:
        return empty_frame(spark, KEY_SCHEMA)
    return spark.read.schema(KEY_SCHEMA).parquet(*(f"{folder}/{name}" for name in sorted(there)))


def organized_keys(spark: SparkSession, root: str, drops: DataFrame | None = None) -> DataFrame:
    """Keys of the drops that were organized, those without rows included.

    They are read from the manifest, whatever the size of the tree. A tree that other means have
    filled has none; it is listed once, and the list becomes its manifest. With ``drops`` only the
    buckets are read that those fall into, which hold all of them that were organized, and others.
    """
    if not _ensured(spark, root):
        return empty_frame(spark, KEY_SCHEMA)
    since = _read_keys(spark, _of_runs(spark, root))
    return _in_buckets(spark, root, drops).unionByName(since).distinct()


def record_organized(drops: DataFrame, root: str) -> None:
    """Add drops to the manifest, once their folders are complete."""
    run = f"{manifest(root)}/runs/{uuid.uuid4().hex}"
    drops.select(*ORGANIZED_KEYS).distinct().write.parquet(run)


def compact_manifest(spark: SparkSession, root: str) -> None:
    """Put the keys of the runs into a new generation of buckets.

    It is in use from one moment to the next. Only the runs that it holds are removed, and only then, so a
    run that stops loses no key and one that adds keys meanwhile keeps them.
    """
    runs = _of_runs(spark, root)
    whole = _in_buckets(spark, root, None).unionByName(_read_keys(spark, runs)).distinct()
    buckets = max(1, -(-whole.count() // KEYS_PER_BUCKET))

    def write(folder: str) -> None:
        rows = whole.select(*ORGANIZED_KEYS, _bucket(buckets)).repartition("bucket")
        rows.sortWithinPartitions("bucket", *ORGANIZED_KEYS).write.partitionBy("bucket").parquet(folder)

    write_generation(spark, manifest(root), write, note=f"-{buckets}")
    for run in runs:
        if run == manifest(root):
            for name in names_in(spark, run):
                if name.endswith(".parquet"):
                    remove_folder(spark, f"{run}/{name}")
        else:
            remove_folder(spark, run)


def closed_before(spark: SparkSession, root: str) -> str | None:
    """The day (``yyyymmdd``) before which all days are closed."""
    days = [name for name in names_in(spark, f"{manifest(root)}/closed") if name.isdigit()]
    return max(days, default=None)


def close_days(spark: SparkSession, root: str, before: date) -> None:
    """Say that no drops of days before this one are to come: runs of the organizer need not list them again.

    A day that is closed stays so. The names are days, of which the last counts.
    """
    mark(spark, f"{manifest(root)}/closed/{before:%Y%m%d}")


def listed_keys(spark: SparkSession, root: str) -> DataFrame:
    """Keys that have a folder, from the listing alone (no file is opened)."""

    def read() -> DataFrame:
        files = spark.read.format("binaryFile").load(f"{root}/category=*/file_key=*")
        folder = F.col("_metadata.file_path")
        return files.select(
            *(
                # Once for the path's own encoding, once for the folder name's escapes.
                decoded(decoded(F.regexp_extract(folder, f"/{key}=([^/]+)/", 1))).alias(key)
                for key in ORGANIZED_KEYS
            )
        ).distinct()

    if not path_exists(spark, root):
        return empty_frame(spark, KEY_SCHEMA)
    return matches_or_empty(spark, KEY_SCHEMA, read)
