"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import remove_folder
from ..session import work_path

#: Rows whose join side is at most this large may be broadcast; beyond it Spark shuffles.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Removes what is stored while the block runs when it ends, but for the tables to be kept."""
    paths: list[str] = []
    before = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(before)
        for path in paths:
            remove_folder(spark, path)


def stored(spark: SparkSession, rows: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """The rows, written to the shared folder and read again: cuts the lineage for good.

    What a result reads later must be kept.
    """
    path = work_path(spark, name)
    if not keep and _passing.get() is not None:
        _passing.get().append(path)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def broadcast_if_small(rows: DataFrame, bytes_per_row: int) -> DataFrame:
    """The rows with a broadcast hint if their number, counted here, keeps them under the bound."""
    if rows.count() * bytes_per_row <= BROADCAST_BYTES:
        return F.broadcast(rows)
    return rows.hint("merge")


def row_key(*columns: str):
    """Names a row by its content, so that a repeated row is the same row."""
    return F.xxhash64(*(F.col(c) for c in columns))


def pieces_of(batches: Iterator[pa.RecordBatch], column: str, max_chars: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about max_chars characters, a row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > max_chars:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
