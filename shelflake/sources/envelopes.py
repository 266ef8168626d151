"""Raw JSON responses, one document per request."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ENVELOPE_READ_SCHEMA = "body string, category string"


def read_envelopes(spark: SparkSession, root: str, *, whole_files: bool = True) -> DataFrame:
    """Responses under ``root/category=<category>/`` as ``(category, body)``.

    ``whole_files`` takes each file as one document; otherwise each line is one, which
    lets Spark split large files and is the better form for many responses.
    """
    lines = spark.read.schema(ENVELOPE_READ_SCHEMA).text(root, wholetext=whole_files)
    return lines.select("category", "body")
