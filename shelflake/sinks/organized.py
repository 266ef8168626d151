"""Writing the organized tree.

There is no shuffle: every task writes the drops it has read. A drop small enough for
one task becomes one file; a large one becomes one file for each of its splits, so no
task ever has to take a whole drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import any_match
from ..schema import LAKE_SCHEMA
from ..sources.missing import empty_frame
from ..sources.organized import KEY_SCHEMA, ORGANIZED_KEYS


def _replace_folders(rows: DataFrame, root: str, *keys: str) -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(root)
    )


def write_organized(rows: DataFrame, root: str) -> None:
    """``category=/file_key=``: one folder per drop, replaced as a whole."""
    _replace_folders(rows.select(*LAKE_SCHEMA.names, *ORGANIZED_KEYS), root, *ORGANIZED_KEYS)


def write_unmatched(rows: DataFrame, root: str) -> None:
    """``file_key=``: drops whose name tells no category."""
    _replace_folders(rows.select(*LAKE_SCHEMA.names, "file_key"), root, "file_key")


def write_left_over(rows: DataFrame, root: str, batch_id: int) -> None:
    """``reason=/batch=``: what a streaming batch did not organize."""
    marked = rows.withColumn("batch", F.lit(batch_id).cast("bigint"))
    _replace_folders(marked, root, "reason", "batch")


def read_left_over(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """What was kept of a streaming batch."""
    schema = T.StructType([*LAKE_SCHEMA.fields, *KEY_SCHEMA.fields, T.StructField("reason", T.StringType())])

    path = f"{root}/reason=*/batch={batch_id}"
    if not any_match(spark, path):
        return empty_frame(spark, schema)
    return spark.read.schema(schema).option("basePath", root).parquet(path)
