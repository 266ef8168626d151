"""Load whatever has arrived in the lake since the last run into the warehouse table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import decoded
from ..plans.load import replace, stage
from ..schema import PARTITIONED_LAKE_SCHEMA
from ..session import passing_path
from ..sinks.warehouse import Warehouse, create_table
from ..sources.lake import category_day, read_folders
from .source import MAX_FILE_AGE


def _folders(batch: DataFrame) -> list[str]:
    """The category-day folders that a batch's files lie in. As many as were written, not as their
    rows.
    """
    file = decoded(F.col("_metadata.file_path"))
    folder = F.regexp_extract(file, "^(.*)/[^/]*$", 1).alias("folder")
    return [row.folder for row in batch.select(folder).distinct().collect()]


def load_new_files(
    spark: SparkSession,
    lake_root: str,
    warehouse: Warehouse,
    checkpoint: str,
    *,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start a run that loads every category-day with files not loaded yet, then stops.

    ``files_per_batch`` splits a large backlog into batches, so that a failure repeats only the last
    of them; the run still ends with everything loaded.

    The checkpoint remembers the files; run it on the scheduler's timetable. New files tell which
    category-days have changed. Those are read whole and replaced in the table and its rejects, so a
    batch repeated after a failure adds nothing, and a day that was written again is there once.
    """
    create_table(spark, warehouse)

    def write(batch: DataFrame, batch_id: int) -> None:
        # The caller's session and not the batch's own, so that the caller sees the table change.
        with passing_path(spark, "load") as path:
            folders = _folders(batch)
            staged = stage(read_folders(spark, lake_root, folders), path)
            replace(spark, staged, warehouse, {category_day(folder) for folder in folders})

    source = spark.readStream.schema(PARTITIONED_LAKE_SCHEMA).option("maxFileAge", MAX_FILE_AGE)
    if files_per_batch is not None:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    return (
        source.parquet(lake_root)
        .select("_metadata")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
