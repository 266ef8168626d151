"""What of the lake has been loaded, told by the files of each category-day.

A line holds the number, size and newest time of a category-day's files and a digest of their names,
sizes and times. Lines are kept and compared by month, so a run holds what it looks at and not the
history, and the number of files does not matter: the ledger has none of their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import any_match, matches, names_in
from ..functions import decoded
from ..generations import newest_generation, write_generation
from ..schema import PARTITION_COLUMNS
from .missing import empty_frame

#: A year and a month, as the lake's folders have them.
Month = tuple[str, str]

LEDGER_SCHEMA = T.StructType(
    [
        *(T.StructField(name, T.StringType()) for name in PARTITION_COLUMNS),
        T.StructField("files", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("newest", T.TimestampType()),
        T.StructField("names", T.LongType()),
    ]
)


def months(spark: SparkSession, lake_root: str, ledger_root: str, since: date | None = None) -> Iterator[Month]:
    """The months that the lake or the ledger has, in order."""
    found = set()
    for folder in matches(spark, f"{lake_root}/category=*/year=*/month=*"):
        year, month = (part.partition("=")[2] for part in folder.rsplit("/", 2)[1:])
        found.add((year, month))
    for name in names_in(spark, ledger_root):
        if name.startswith("month="):
            found.add((name[6:10], name[10:12]))
    first = ("", "") if since is None else (f"{since:%Y}", f"{since:%m}")
    return iter(sorted(month for month in found if month >= first))


def listed_month(spark: SparkSession, lake_root: str, month: Month) -> DataFrame:
    """The lines of a month as its files are now, from the listing alone."""
    path = f"{lake_root}/category=*/year={month[0]}/month={month[1]}/day=*"

    if not any_match(spark, path):
        return empty_frame(spark, LEDGER_SCHEMA)
    files = spark.read.format("binaryFile").load(path)
    uri = F.col("_metadata.file_path")
    plain = decoded(uri)
    keys = [decoded(F.regexp_extract(plain, f"/{key}=([^/]*)/", 1)).alias(key) for key in PARTITION_COLUMNS]
    size, time = F.col("_metadata.file_size"), F.col("_metadata.file_modification_time")
    lines = files.select(*keys, size.alias("size"), time.alias("time"), F.xxhash64(uri, size, time).alias("file"))
    return lines.groupBy(*PARTITION_COLUMNS).agg(
        F.count("*").alias("files"),
        F.sum("size").alias("bytes"),
        F.max("time").alias("newest"),
        F.bit_xor("file").alias("names"),
    )


def _of_month(ledger_root: str, month: Month) -> str:
    return f"{ledger_root}/month={''.join(month)}"


def recorded_month(spark: SparkSession, ledger_root: str, month: Month) -> DataFrame:
    """The lines of a month as they were when it was loaded."""
    folder = newest_generation(spark, _of_month(ledger_root, month))
    if folder is None:
        return empty_frame(spark, LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(folder)


def changed_lines(listed: DataFrame, recorded: DataFrame) -> DataFrame:
    """Lines that are new or differ, and lines of category-days that are gone, without files."""
    same = F.lit(True)
    for name in LEDGER_SCHEMA.names:
        same &= F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
    changed = listed.alias("l").join(recorded.alias("r"), same, "left_anti").select("l.*")
    gone = recorded.join(listed, list(PARTITION_COLUMNS), "left_anti").select(
        *PARTITION_COLUMNS,
        *(F.lit(0 if f.name == "files" else None).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA[4:]),
    )
    return changed.unionByName(gone)


def record_lines(spark: SparkSession, ledger_root: str, month: Month, lines: list) -> None:
    """Put lines in the place of those of the same category-days. A line without files ends one."""
    fresh = spark.createDataFrame(lines, LEDGER_SCHEMA)
    kept = recorded_month(spark, ledger_root, month).join(fresh, list(PARTITION_COLUMNS), "left_anti")
    whole = kept.unionByName(fresh.where("files > 0")).coalesce(1)
    write_generation(spark, _of_month(ledger_root, month), whole.write.mode("overwrite").parquet)
