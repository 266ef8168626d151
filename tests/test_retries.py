"""Tasks that die after they have done their work: results and counts stay exact."""

from __future__ import annotations

from datetime import timedelta

import pytest
from builders import NOON, listing, listings

from shelflake.operators import category_status, parsed
from shelflake.plans import ingest
from shelflake.plans.load import stage
from shelflake.sinks import write_flat, write_organized, write_partitioned
from shelflake.sources import read_flat, read_lake, read_organized


def dying_once(frame):
    """The same rows, but each task's first attempt fails after its last row."""

    def pass_on(batches):
        from pyspark import TaskContext

        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost on purpose")

    return frame.mapInPandas(pass_on, frame.schema)


@pytest.fixture
def rows(spark):
    made = [listing(rank=n, fetch_timestamp=NOON + timedelta(days=n % 2)) for n in range(300)]
    made += [listing(rank=300 + n, asin=None) for n in range(20)]
    return dying_once(listings(spark, made).repartition(5))


def test_staged_rows_and_counts(spark, rows, root):
    staged = stage(rows, root)
    assert (staged.rows_read, staged.rows_rejected) == (320, 20)
    assert sorted(r.rank for r in staged.accepted(spark).collect()) == list(range(300))
    assert staged.rejected(spark).count() == 20


@pytest.mark.parametrize("rebalance", [True, False])
def test_lake_writes(spark, rows, root, rebalance):
    write_partitioned(rows, root, rebalance=rebalance)
    assert sorted(r.rank for r in read_lake(spark, root).collect()) == list(range(320))


def test_flat_and_organized_writes(spark, rows, root, tmp_path):
    write_flat(rows, root)
    write_organized(dying_once(read_flat(spark, root)), str(tmp_path / "organized"))
    back = read_organized(spark, str(tmp_path / "organized"))
    assert sorted(r.rank for r in back.collect()) == list(range(320))


def test_ingest_status(spark, root):
    body = '{"data":{"best_sellers":[{"rank":1},{"rank":2}]}}'
    responses = spark.createDataFrame(
        [("kitchen", body)] * 50 + [("kitchen", "not json")] * 7, "category string, body string"
    ).repartition(5)
    ingest(dying_once(responses), root)
    assert read_lake(spark, root).count() == 100
    status = category_status(parsed(dying_once(responses))).first()
    assert (status.response_count, status.failed_count, status.row_count) == (57, 7, 100)
