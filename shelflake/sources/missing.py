"""Reading a place that may not exist yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..files import path_exists

_NO_SUCH_PATH = "PATH_NOT_FOUND"


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """Parquet at ``path``, or no rows if there is no such path."""
    if not path_exists(spark, path):
        return empty_frame(spark, schema)
    return spark.read.schema(schema).parquet(path)


def matches_or_empty(
    spark: SparkSession, schema: T.StructType, read: Callable[[], DataFrame]
) -> DataFrame:
    """``read()`` of a path pattern, or no rows if nothing matches it.

    Every other error is raised.
    """
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() != _NO_SUCH_PATH:
            raise
        return empty_frame(spark, schema)
