"""Keeping a listing of files at hand."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

@contextmanager
def kept(listing: DataFrame) -> Iterator[DataFrame]:
    """The listing, computed once and cached while the block runs.

    A listing reads names and no contents, so the sizes of the files must not decide
    its number of tasks: by size, a large lake would get one task for every file.
    """
    cores = listing.sparkSession.sparkContext.defaultParallelism
    cached = listing.coalesce(cores).persist()
    cached.count()
    try:
        yield cached
    finally:
        cached.unpersist()
