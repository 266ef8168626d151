"""Small tables for the tests, with every oddity a table can have."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrame, SparkSession

#: The columns of documents, and some whose names the operators might use themselves.
CLASHES = ("key", "kept", "row", "node", "label", "line_no", "class_id", "hits", "tails", "n", "count")
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, words: int, lines: int = 1) -> str:
    source = random.Random(seed)
    made = ["".join(source.choices("abcdefghiklmnoprstuvéß", k=source.randint(2, 9))) for _ in range(words)]
    step = max(1, words // lines)
    return "\n".join(" ".join(made[i : i + step]) for i in range(0, words, step))


def odd_documents(spark: SparkSession, clashes: bool = True) -> DataFrame:
    """NULLs, empty, blank and very long texts, copies, near copies and repeated rows."""
    base = prose(1, 120, 4)
    near = base.replace(base.split()[3], "changed", 1)
    texts = [
        (1, base),
        (2, base),
        (3, near),
        (3, near),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "one"),
        (8, "one"),
        (9, prose(2, 40_000, 100)),
        (10, "😀 é\u0000 x " * 30),
        (11, prose(3, 60)),
        (12, prose(4, 4)),
        (12, prose(5, 30)),
        (None, prose(6, 30)),
        (None, None),
        (-1, prose(3, 60) + " tail"),
    ]
    rows = [
        (i, t, None if n % 3 else "en", None if n % 4 else "s", None if t is None else len(t))
        for n, (i, t) in enumerate(texts)
    ]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    if clashes:
        for name in CLASHES:
            docs = docs.selectExpr("*", f"'own' AS {name}")
    return docs


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENTS)


def odd_labels(spark: SparkSession) -> DataFrame:
    rows = [(1, 1, 0), (1, 0, 1), (2, None, 0), (None, 1, 0), (3, 1, None), (11, 1, 0), (999, 0, 0), (9, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int").selectExpr(
        "*", "'own' AS grade", "'own' AS text"
    )


def odd_benchmark(spark: SparkSession) -> DataFrame:
    words = prose(3, 60).split()
    rows = [
        (1, " ".join(words[10:40])),
        (2, None),
        (3, ""),
        (4, "ONE"),
        (None, " ".join(words[:20])),
        (5, " ".join(words[10:40])),
        (5, "never there at all"),
    ]
    return spark.createDataFrame(rows, "item_id bigint, text string").selectExpr("*", "'own' AS doc_id")


def odd_pages(spark: SparkSession) -> DataFrame:
    article = f"<article><h1>Head</h1><p>{prose(7, 40)}.</p></article>"
    rows = [
        (1, "http://a/1", article),
        (2, "http://a/2", article),
        (2, "http://a/2", article),
        (3, None, None),
        (4, "", ""),
        (5, "http://a/ 5\r\nX: y", "<p>" * 5000 + "deep" + "</p>" * 5000),
        (None, None, article),
        (6, "http://a/6", "<script>never closed"),
        (7, "http://a/7", "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 3),
        (8, "http://a/8", "no markup & &amp; no end <"),
        (9, "http://a/9", f"<p>{prose(8, 30_000)}</p>"),
    ]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr(
        "*", "'own' AS text", "'own' AS payload", "'own' AS digest"
    )


def odd_conversations(spark: SparkSession) -> DataFrame:
    rows = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", "hello"),
        (2, 0, "user", "hi"),
        (2, 1, "assistant", "hello"),
        (2, 2, "user", "more"),
        (3, 0, "user", "hi"),
        (3, 1, "assistant", "hello"),
        (3, 2, "user", "more"),
        (3, 2, "user", "more"),
        (4, 0, "user", None),
        (5, 0, "user", ""),
        (5, 1, None, "x"),
        (None, 0, "user", "alone"),
        (6, None, "user", "hi"),
        (6, 7, "assistant", "hello"),
        (7, 3, "b", "tie"),
        (7, 3, "a", "tie"),
        (8, 0, "user", "long " * 50_000),
    ]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr(
        "*", "'own' AS place", "'own' AS stretch", "'own' AS h1"
    )


def odd_embeddings(spark: SparkSession) -> DataFrame:
    source = random.Random(9)
    usual = [[source.gauss(0, 0.2) for _ in range(4)] for _ in range(30)]
    rows = [
        *((i, v) for i, v in enumerate(usual)),
        (0, usual[0]),
        *((100 + i, usual[1]) for i in range(200)),
        (400, None),
        (401, []),
        (402, [0.1, None, 0.2, 0.3]),
        (403, [0.1, float("nan"), 0.2, 0.3]),
        (404, [0.1, float("inf"), 0.2, 0.3]),
        (405, [0.1, 0.2]),
        (None, usual[2]),
    ]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr(
        "*", "'own' AS x", "'own' AS component", "'own' AS n"
    )


def save(root: str, **tables: DataFrame) -> str:
    for name, rows in tables.items():
        rows.write.parquet(f"{root}/{name}.parquet")
    return root


def odd_tables(spark: SparkSession, root: str) -> str:
    return save(
        root,
        documents=odd_documents(spark),
        labels=odd_labels(spark),
        benchmark=odd_benchmark(spark),
        pages=odd_pages(spark),
        conversations=odd_conversations(spark),
        embeddings=odd_embeddings(spark),
    )


def empty_tables(spark: SparkSession, root: str) -> str:
    return save(
        root,
        documents=no_documents(spark),
        labels=odd_labels(spark).limit(0),
        benchmark=odd_benchmark(spark).limit(0),
        pages=odd_pages(spark).limit(0),
        conversations=odd_conversations(spark).limit(0),
        embeddings=odd_embeddings(spark).limit(0),
    )


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    return odd_tables(spark, str(tmp_path_factory.mktemp("odd") / "t"))


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    return empty_tables(spark, str(tmp_path_factory.mktemp("empty") / "t"))
