"""Flat drops: one file or folder per category and day, all in one place."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import category_of, decoded, file_key, file_name
from ..schema import FILE_PREFIX, FLAT_KEY, LAKE_SCHEMA
from .missing import matches_or_empty

FILE_URI = "file_uri"

DROP_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (FILE_URI, "file_path", "filename", "file_key", "category")
    ]
)


def flat_glob(root: str, prefix: str = FILE_PREFIX, since: str | None = None) -> str:
    """All forms of a drop: single files, folders of that name, and the folders of the flat sink.

    With ``since`` (``yyyymmdd``) drops whose key ends in an earlier day are left out, by their names alone.
    """
    plain = re.sub(r"[\[\]{}*?,\\]", r"\\\g<0>", prefix)
    keys = [f"{plain}*"] if since is None else _keys_since(plain, since)
    # A folder's name is the key; in front of the ending of a file stands anything that begins so.
    return f"{root}/{{{','.join([*(f'{key}.parquet' for key in keys), *(f'{FLAT_KEY}={key}' for key in keys)])}}}"


#: Characters of a key that tell its day: an underscore and eight digits.
_DAY = 8


def _keys_since(prefix: str, since: str) -> list[str]:
    """Patterns of the keys that end in the day or a later one, and of those that end in none."""
    days = [since]
    for n, digit in enumerate(since):
        if digit < "9":
            following = str(int(digit) + 1)
            later = following if following == "9" else f"[{following}-9]"
            days.append(since[:n] + later + "[0-9]" * (_DAY - 1 - n))
    dated = [f"{prefix}*_{day}" for day in days]
    short = [prefix + "?" * n for n in range(_DAY + 1)]
    undated = [f"{prefix}*[^0-9]" + "?" * n for n in range(_DAY)]
    return [*dated, *short, *undated, f"{prefix}*[^_]" + "?" * _DAY]


def with_uri(scan: DataFrame) -> DataFrame:
    """Add each row's file, as the encoded URI Spark reports. It is constant per file."""
    return scan.withColumn(FILE_URI, F.col("_metadata.file_path"))


def with_lineage(files: DataFrame, prefix: str = FILE_PREFIX) -> DataFrame:
    """Add path, name, drop key and category to rows that have their file's URI."""
    return (
        files.withColumn("file_path", decoded(F.col(FILE_URI)))
        .withColumn("filename", file_name(F.col("file_path")))
        .withColumn("file_key", file_key(F.col("file_path")))
        .withColumn("category", category_of(F.col("file_key"), prefix))
    )


def scan_flat(spark: SparkSession, root: str, prefix: str = FILE_PREFIX) -> DataFrame:
    """Rows of all drops with their file's URI; no rows if there are no drops."""
    schema = T.StructType(LAKE_SCHEMA.fields + [DROP_SCHEMA[FILE_URI]])

    def read() -> DataFrame:
        return with_uri(spark.read.schema(LAKE_SCHEMA).parquet(flat_glob(root, prefix)))

    return matches_or_empty(spark, schema, read)


def read_flat(spark: SparkSession, root: str, prefix: str = FILE_PREFIX) -> DataFrame:
    """Rows of all drops with their lineage columns."""
    return with_lineage(scan_flat(spark, root, prefix), prefix)


def drop_files(
    spark: SparkSession, root: str, prefix: str = FILE_PREFIX, since: str | None = None
) -> DataFrame:
    """The data files of all drops, or of those not before a day, from the file listing alone.

    The content column is not selected, so no file is opened, and files without rows
    are listed too.
    """
    schema = T.StructType([DROP_SCHEMA[FILE_URI]])

    def read() -> DataFrame:
        listing = spark.read.format("binaryFile").load(flat_glob(root, prefix, since))
        return with_uri(listing).select(FILE_URI)

    return with_lineage(matches_or_empty(spark, schema, read), prefix)
