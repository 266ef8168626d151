"""The feed of a larger part table is made by many tasks, whatever keys its rows share."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from compare import oracle, oracle_rows, spark_rows
from pyspark.sql import functions as F

from shelflake import feed
from shelflake.catalogue import QUERIES
from shelflake.oracles import ORACLES

COLUMNS = pa.schema(
    {
        "p_partkey": pa.int64(),
        "p_name": pa.string(),
        "p_brand": pa.string(),
        "p_type": pa.string(),
        "p_size": pa.int32(),
        "p_retailprice": pa.float64(),
    }
)


def write_parts(folder, rows) -> str:
    """One file of one row group: Spark cannot split it."""
    folder.mkdir(exist_ok=True)
    table = pa.table(list(map(list, zip(*rows))), schema=COLUMNS)
    pq.write_table(table, folder / "part.parquet")
    return str(folder)


@pytest.fixture
def sf_dir(tmp_path, monkeypatch):
    """A table of one file, some of whose rows come twice, dealt out ten rows to a task."""
    monkeypatch.setattr(feed, "PARTS_PER_TASK", 10)
    kinds = ("LARGE", "SMALL", "ECONOMY")
    rows = [(k % 40, f"name {k}", "Brand#1", kinds[k % 3], k % 50, 900.0 + k) for k in range(90)]
    return write_parts(tmp_path / "parts", rows + rows[:10])


def tasks(rows) -> list[int]:
    return [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]


def test_responses_are_made_by_many_tasks(spark, sf_dir):
    found = tasks(feed.raw_envelopes(spark, sf_dir))
    assert len(found) >= 7
    assert sum(found) == 200
    assert max(found) <= 70


def test_a_key_that_all_parts_share_is_no_task_of_its_own(spark, sf_dir, tmp_path):
    rows = [(7, "n", "b", "LARGE", 1, 1.0)] * 100 + [(None,) * len(COLUMNS)] * 100
    found = tasks(feed.parts(spark, write_parts(tmp_path / "hot", rows)))
    assert len(found) >= 15
    assert sum(found) == 200
    assert max(found) <= 40


def test_a_small_table_is_not_shuffled(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(feed, "PARTS_PER_TASK", 100)
    assert feed.parts(spark, sf_dir).columns == COLUMNS.names
    assert tasks(feed.parts(spark, sf_dir)) == [100]


def test_ingest_lake_of_a_dealt_table(spark, sf_dir):
    found = spark_rows(QUERIES["ingest_lake"](spark, sf_dir))
    assert found == oracle_rows(oracle(sf_dir, ORACLES["ingest_lake"]))


def test_file_names_are_told_by_many_tasks(spark, sf_dir):
    result = QUERIES["file_names"](spark, sf_dir)
    found = tasks(result)
    assert len(found) >= 7
    assert sum(found) == 1200
    assert max(found) <= 420
    assert spark_rows(result) == oracle_rows(oracle(sf_dir, ORACLES["file_names"]))


def test_a_file_name_is_encoded_once_for_its_forms(spark, sf_dir):
    plan = QUERIES["file_names"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("UrlCodec.encode") == 1
