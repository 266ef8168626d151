"""The registered query of each corpus operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..files import remove_folder
from ..session import work_path
from . import (
    chat,
    decontaminate,
    fill_in_middle,
    html_extract,
    line_dedup,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    secrets,
    sentence_pieces,
    warc,
    whitening,
)
from .common import stored, table
from .oracles import ORACLES
from .shipping import shipped

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = shipped(query)
    return QUERIES[query.__name__]


@registered
def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


@registered
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expected grade of each document, its tail probabilities and the verdict."""
    return quality_classifier.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through WARC archives and back."""
    path = work_path(spark, "archives")
    records = stored(spark, warc.round_trip(table(spark, sf_dir, "pages"), path), "warc-read")
    remove_folder(spark, path)
    return records


@registered
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations that no other one continues, rendered."""
    return chat.render(table(spark, sf_dir, "conversations"))


@registered
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class and links of each line of the documents."""
    return line_dedup.report(table(spark, sf_dir, "documents"))


@registered
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of each document."""
    return secrets.report(table(spark, sf_dir, "documents"))


@registered
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each document is verbatim in the test set."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of each document and the verdict of the current policy."""
    return quality_rules.report(table(spark, sf_dir, "documents"))


@registered
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of each document."""
    return near_dedup.report(table(spark, sf_dir, "documents"))


@registered
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as pieces of packed sequences."""
    return packing.pack(table(spark, sf_dir, "documents"))


@registered
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document cut in three, and rebuilt."""
    return fill_in_middle.report(table(spark, sf_dir, "documents"))


@registered
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings on the axes of their covariance, each of unit variance."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@registered
def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of each document, and the text they are decoded to."""
    return sentence_pieces.report(table(spark, sf_dir, "documents"))
