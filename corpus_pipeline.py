"""The corpus pipeline: quality, line dedup, near dedup, decontamination, packing.

Each stage works on all that its predecessor kept and is stored before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelflake.llm import (
    decontaminate,
    line_dedup,
    near_dedup,
    packing,
    quality_classifier,
)
from shelflake.llm.common import stored, table
from shelflake.llm.shipping import shipped


@shipped
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality_classifier.selected(docs, table(spark, sf_dir, "labels"))


@shipped
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without repeated lines, and without documents of nothing else."""
    return line_dedup.deduplicated(docs)


@shipped
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup.deduplicated(docs)


@shipped
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that share a passage with the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


@shipped
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontaminate", benchmark),
    ("packing", packed),
]

#: Training, joins by edit distance and tokens are beyond SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


@shipped
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
