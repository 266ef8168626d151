"""Gap-free surrogate keys without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Number of groups (a power of two) the per-file counts are summed in. The last step
# sees one row per group, so it is bounded by this constant.
_GROUPS = 512

# Spark names a file by the task that wrote it and a running number.
_TASK, _PART = r"^part-(\d+)-", r"^.*[-.]c(\d+)\."
_PARTS_PER_TASK = 1 << 20


def file_number() -> Column:
    """Tells the files of one write apart, by the numbers in their names."""
    name = F.col("_metadata.file_name")
    task, part = (F.regexp_extract(name, p, 1).cast("bigint") for p in (_TASK, _PART))
    return task * _PARTS_PER_TASK + part


def with_identity(stored: DataFrame, column: str, *, after: int = 0) -> DataFrame:
    """Number the rows of a Parquet dataset that one Spark job has written ``after + 1, after + 2, …``.

    A row's number is the running count of the files before its own plus its position
    in the file. Both are properties of the written files, so a recomputed task gives
    the same numbers. Counting needs the file footers only. Files go by the number in their name,
    so an offset is two numbers; the offsets are as many as one job has tasks, a few MB for a
    hundred thousand, and are broadcast: no row is shuffled.
    """
    per_file = stored.select(file_number().alias("id_file")).groupBy("id_file").count()
    grouped = per_file.withColumn("id_group", F.xxhash64("id_file").bitwiseAND(_GROUPS - 1))

    before_in_group = Window.partitionBy("id_group").orderBy("id_file").rowsBetween(
        Window.unboundedPreceding, -1
    )
    in_group = grouped.withColumn(
        "id_inner", F.coalesce(F.sum("count").over(before_in_group), F.lit(0))
    )
    before_group = Window.orderBy("id_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = (
        grouped.groupBy("id_group")
        .agg(F.sum("count").alias("total"))
        .select(
            "id_group",
            F.coalesce(F.sum("total").over(before_group), F.lit(0)).alias("id_outer"),
        )
    )
    offsets = in_group.join(F.broadcast(groups), "id_group").select(
        "id_file", (F.col("id_inner") + F.col("id_outer")).alias("id_offset")
    )
    placed = stored.withColumns(
        {"id_file": file_number(), "id_position": F.col("_metadata.row_index")}
    )
    number = F.col("id_offset") + F.col("id_position") + F.lit(after + 1).cast("bigint")
    return placed.join(F.broadcast(offsets), "id_file").select(number.alias(column), *stored.columns)
