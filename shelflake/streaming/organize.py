"""Move new flat drops into the organized tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..files import make_folder, mark, path_exists, remove_folder, renamed, resolved
from ..operators import files_behind, matched, not_organized
from ..schema import FILE_PREFIX, LAKE_SCHEMA
from ..session import passing_path
from ..sinks.organized import read_left_over, write_left_over, write_organized
from ..sources import organized_keys, read_or_empty
from ..sources.flat import FILE_URI, flat_glob, with_uri
from ..sources.listing import kept
from ..sources.organized import KEY_SCHEMA, ORGANIZED_KEYS, read_drops, record_organized
from .source import MAX_FILE_AGE


def _claimed_keys(spark: SparkSession, files: DataFrame, target_root: str, path: str) -> DataFrame:
    """The batch's drops that had no folder when the batch was first tried.

    They are written down before any row is. A repeated batch reads them back, so it
    does not take its own half-finished work for drops that were there before.
    """
    claims = f"{path}/done=true"
    if not path_exists(spark, claims):
        drops = matched(files).select(*ORGANIZED_KEYS).distinct()
        (
            not_organized(drops, organized_keys(spark, target_root, drops))
            .withColumn("done", F.lit(True))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("done")
            .parquet(path)
        )
    return read_or_empty(spark, KEY_SCHEMA, claims)


_OUTCOME = "outcome"
_ORGANIZED, _ALREADY, _UNNAMED = "organized", "already_organized", "no_category"


def _outcomes(files: DataFrame, claims: DataFrame) -> DataFrame:
    """What becomes of each file of the batch."""
    claimed = claims.withColumn("claimed", F.lit(True))
    outcome = F.when(F.col("category") == "", _UNNAMED).when(F.col("claimed"), _ORGANIZED).otherwise(_ALREADY)
    return files.join(claimed, list(ORGANIZED_KEYS), "left").withColumn(_OUTCOME, outcome)


def _staged(batch: DataFrame, outcomes: DataFrame, path: str) -> DataFrame:
    """The rows of the batch with their outcome, stored: the one time that their contents are read."""
    known = outcomes.select(FILE_URI, *ORGANIZED_KEYS, _OUTCOME)
    rows = batch.join(known, FILE_URI).select(*LAKE_SCHEMA.names, *ORGANIZED_KEYS, _OUTCOME)
    rows.write.mode("overwrite").partitionBy(_OUTCOME).parquet(path)
    return batch.sparkSession.read.schema(rows.schema).parquet(path)


def _short(batch: DataFrame, outcomes: DataFrame, organized: DataFrame, left_over: DataFrame) -> list[str]:
    """Keys of the drops that have not as many rows where they went as in their sources, by the footers."""
    known = outcomes.select(FILE_URI, "file_key", _OUTCOME)
    sources = batch.groupBy(FILE_URI).count().join(known, FILE_URI)
    expected = sources.groupBy("file_key", _OUTCOME).agg(F.sum("count").alias("expected"))
    stored = organized.groupBy("file_key").count().withColumn(_OUTCOME, F.lit(_ORGANIZED))
    stored = stored.unionByName(left_over.groupBy("file_key", F.col("reason").alias(_OUTCOME)).count())
    compared = expected.join(stored, ["file_key", _OUTCOME], "left")
    wrong = F.coalesce("count", F.lit(0)) != F.col("expected")
    return sorted(row.file_key for row in compared.where(wrong).select("file_key").distinct().collect())


def _retire(spark: SparkSession, files: DataFrame, flat_root: str, archive_root: str | None) -> None:
    """Move the batch's files to the same place under the archive, or remove them. They may be gone already."""
    base = resolved(spark, flat_root)
    for row in files.select("file_path").toLocalIterator():
        if archive_root is None:
            remove_folder(spark, row.file_path)
        elif path_exists(spark, row.file_path):
            target = f"{archive_root}/{resolved(spark, row.file_path).removeprefix(base).lstrip('/')}"
            make_folder(spark, target.rsplit("/", 1)[0])
            remove_folder(spark, target)
            renamed(spark, row.file_path, target)


def organize_new_drops(
    spark: SparkSession,
    flat_root: str,
    target_root: str,
    checkpoint: str,
    *,
    rejects_root: str,
    prefix: str = FILE_PREFIX,
    clean_source: str = "off",
    archive_root: str | None = None,
) -> StreamingQuery:
    """Start a run that organizes every drop not seen yet, then stops.

    The checkpoint remembers the files, also those without rows. Rows of drops that
    have a folder already, or whose name tells no category, are kept in
    ``rejects_root`` by reason, so retiring the sources loses nothing.

    ``clean_source`` is ``off``, ``archive`` (to ``archive_root``, which must lie
    outside ``flat_root``) or ``delete``. The files of a batch are retired in the run that has
    organized them, once every drop has as many rows where it went as in its sources, by the footers
    of both; otherwise none is, and the run fails. Files without rows stay.

    A folder drop must be published whole; its files belong to one batch.
    """
    if clean_source not in ("off", "archive", "delete"):
        raise ValueError(f"unknown clean_source {clean_source!r}")
    if (clean_source == "archive") != (archive_root is not None):
        raise ValueError("an archive_root goes with clean_source='archive'")
    source = spark.readStream.schema(LAKE_SCHEMA).options(maxFileAge=MAX_FILE_AGE)
    rows = with_uri(source.parquet(flat_glob(flat_root, prefix)))

    def write_batch(batch: DataFrame, files: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        verified = f"{checkpoint}/verified/{batch_id}"
        if not path_exists(session, verified):
            claims = _claimed_keys(session, files, target_root, f"{checkpoint}/claims/{batch_id}")
            with kept(_outcomes(files, claims)) as outcomes, passing_path(session, "organize") as path:
                staged = _staged(batch, outcomes, path)
                organized = staged.where(F.col(_OUTCOME) == _ORGANIZED)
                write_organized(organized, target_root)
                record_organized(claims, target_root)
                left_over = staged.where(F.col(_OUTCOME) != _ORGANIZED).withColumnRenamed(_OUTCOME, "reason")
                if not left_over.isEmpty():
                    write_left_over(left_over, rejects_root, batch_id)
                if clean_source == "off":
                    return
                there = read_drops(session, target_root, claims)
                short = _short(batch, outcomes, there, read_left_over(session, rejects_root, batch_id))
            if short:
                raise RuntimeError(f"not retired, as rows are missing: {', '.join(short)}")
            # From here on the sources may be gone, so a repeated batch must not be written again.
            mark(session, verified)
        _retire(session, files, flat_root, archive_root)

    def write(batch: DataFrame, batch_id: int) -> None:
        # A line per file of the batch, used several times.
        with kept(files_behind(batch, prefix)) as files:
            if clean_source == "off" or not files.isEmpty():
                write_batch(batch, files, batch_id)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
