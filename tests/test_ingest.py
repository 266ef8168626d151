from __future__ import annotations

import json
from datetime import datetime

import pytest
from builders import NOON
from pyspark.sql import functions as F

from shelflake.operators import (
    LOSSES,
    category_status,
    listings_of,
    lost_values,
    parsed,
    responses_and_listings,
    status_lines,
    typed_listings,
    warehouse_losses,
    warehouse_rows,
)
from shelflake.plans import ingest
from shelflake.schema import LAKE_SCHEMA, PARTITIONED_LAKE_SCHEMA
from shelflake.sinks import write_flat
from shelflake.sources import read_day, read_envelopes, read_flat, read_lake

AS_OF = datetime(2024, 1, 2, 3, 0)

FIRST = {"rank": 1, "asin": "A1", "product_title": "T", "product_price": "$4.50",
         "product_star_rating": "4.5", "product_num_ratings": 12, "product_url": "u",
         "product_photo": "p", "rank_change_label": None, "is_best": True}
SECOND = {"rank": "2", "asin": "A2", "product_price": 4.50}


def body(*items) -> str:
    return json.dumps({"status": "OK", "data": {"best_sellers": list(items)}})


@pytest.fixture
def responses(spark):
    return spark.createDataFrame(
        [
            ("kitchen", body(FIRST, SECOND)),
            ("software", body()),
            ("appliances", '{"data":{}}'),
            ("office-products", "not json"),
            ("toys-and-games", None),
            ("mixed", body(FIRST)),
            ("mixed", '{"data":{"best_sellers":[{"rank":1}'),
            ("null-list", '{"data":{"best_sellers":null}}'),
        ],
        "category string, body string",
    )


def test_listings_keep_text_and_drop_unknown_fields(responses):
    rows = {(r.category, r.asin): r for r in listings_of(parsed(responses)).collect()}
    assert set(rows) == {("kitchen", "A1"), ("kitchen", "A2"), ("mixed", "A1")}
    assert rows["kitchen", "A1"].rank == "1"
    assert rows["kitchen", "A2"].product_price == "4.5"
    assert rows["kitchen", "A2"].product_title is None
    assert "is_best" not in rows["kitchen", "A1"]


def test_a_listing_without_any_field_is_still_a_listing(spark):
    one = spark.createDataFrame([("kitchen", body({}))], "category string, body string")
    assert listings_of(parsed(one)).count() == 1


def test_documents_are_parsed_once(responses):
    plan = listings_of(parsed(responses))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_status(responses):
    status = {r.category: r for r in category_status(parsed(responses)).collect()}
    ok = {name for name, row in status.items() if row.ok}
    assert ok == {"kitchen", "software", "mixed"}
    assert (status["kitchen"].row_count, status["software"].row_count) == (2, 0)
    assert (status["mixed"].response_count, status["mixed"].failed_count) == (2, 1)


def test_status_of_asked_categories(responses):
    asked = ["kitchen", "appliances", "garden"]
    status = category_status(parsed(responses, asked), asked)
    lines = {r.category: json.loads(r.status) for r in status_lines(status).collect()}
    assert {name: line["ok"] for name, line in lines.items()} == {
        "kitchen": True, "appliances": False, "garden": False,
    }
    assert lines["garden"]["response_count"] == 0
    assert lines["garden"]["message"] == "no usable response for garden"


def test_typed_listings_have_the_lake_schema(responses):
    rows = typed_listings(listings_of(parsed(responses)).withColumn("fetch_timestamp", _noon()))
    assert [(f.name, f.dataType) for f in rows.schema][:-1] == [
        (f.name, f.dataType) for f in LAKE_SCHEMA
    ]


def _noon():
    from pyspark.sql import functions as F

    return F.lit(NOON.isoformat(sep=" ")).cast("timestamp_ntz")


def test_ingest_writes_one_business_day_and_can_be_repeated(spark, responses, root):
    for _ in range(2):
        status = ingest(responses, root, as_of=AS_OF)
    assert status.where("ok").count() == 3
    lake = read_lake(spark, root)
    assert lake.schema == PARTITIONED_LAKE_SCHEMA
    found = sorted((r.category, r.year, r.month, r.day, r.rank) for r in lake.collect())
    assert found == [
        ("kitchen", "2024", "01", "01", 1),
        ("kitchen", "2024", "01", "01", 2),
        ("mixed", "2024", "01", "01", 1),
    ]
    stamps = {r.fetch_timestamp for r in read_day(spark, root, as_of=AS_OF).collect()}
    assert stamps == {datetime(2024, 1, 1, 22, 0)}


def test_ingest_flat(spark, responses, root):
    ingest(responses, root, as_of=AS_OF, write=write_flat)
    keys = {r.file_key for r in read_flat(spark, root).collect()}
    assert keys == {"amazonbestsellers_kitchen_20240101", "amazonbestsellers_mixed_20240101"}


def test_ingest_of_chosen_categories(spark, responses, root):
    ingest(responses, root, as_of=AS_OF, categories=["mixed"])
    assert {r.category for r in read_lake(spark, root).collect()} == {"mixed"}


@pytest.mark.parametrize("whole_files", [True, False])
def test_stored_responses(spark, tmp_path, whole_files):
    for name in ("007", "kitchen"):
        folder = tmp_path / "in" / f"category={name}"
        folder.mkdir(parents=True)
        text = json.dumps(json.loads(body(FIRST)), indent=2 if whole_files else None)
        (folder / "a.json").write_text(text)
        (folder / "b.json").write_text(text)
    envelopes = read_envelopes(spark, str(tmp_path / "in"), whole_files=whole_files)
    found = sorted((r.category, r.asin) for r in listings_of(parsed(envelopes)).collect())
    assert found == [("007", "A1")] * 2 + [("kitchen", "A1")] * 2


def test_responses_are_parsed_once(spark):
    rows = typed_listings(responses_and_listings(parsed(envelopes(spark))), F.lit(NOON).cast("timestamp_ntz"), "usable", "position")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def envelopes(spark):
    good = body({"rank": "1"}, {"rank": "x"})
    bodies = [("a", good), ("a", "no json"), ("a", '{"data":{"best_sellers":[]}}'), ("b", None), ("b", '{"data":{}}')]
    return spark.createDataFrame(bodies, "category string, body string")


def test_status_of_repeated_tasks(spark, root):
    """Each task dies once after its work; the status is exact and there when the run is."""
    from test_retries import dying_once

    status = ingest(dying_once(envelopes(spark).repartition(3)), root, as_of=NOON, categories=["a", "b", "c"])
    found = {r.category: (r.ok, r.response_count, r.failed_count, r.row_count) for r in status.collect()}
    assert found == {"a": (True, 3, 1, 2), "b": (False, 2, 2, 0), "c": (False, 0, 0, 0)}
    assert sorted(r["rank"] or 0 for r in read_lake(spark, root).collect()) == [0, 1]
    expected = category_status(parsed(envelopes(spark)), ["a", "b", "c"])
    assert sorted(status.collect()) == sorted(expected.collect())
    assert status.schema.simpleString() == expected.schema.simpleString()


def test_lost_numbers(spark):
    rows = [("1", "2", "3.5", "$1"), ("x", None, "NaN", None), ("9999999999", "1e30", "", "free"), (None, "2.5", "bad", "$99999999999")]
    text = spark.createDataFrame(rows, "rank string, product_num_ratings string, product_star_rating string, product_price string")
    others = ("asin", "product_title", "product_url", "product_photo", "rank_change_label")
    text = text.selectExpr("*", *(f"CAST(NULL AS STRING) AS {n}" for n in others), "'c' AS category")
    typed = typed_listings(text, F.lit(NOON).cast("timestamp_ntz"), losses=True)
    bits = F.col(LOSSES).bitwiseOR(warehouse_losses()).alias(LOSSES)
    table = warehouse_rows(typed, bits)
    lost = {r.column_name: (r.n_lost, r.n_rows) for r in lost_values(table, "category").collect()}
    assert lost == {
        "rank": (2, 4), "product_num_ratings": (2, 4), "product_star_rating": (3, 4), "product_price": (2, 4),
    }
    assert [r[LOSSES] for r in table.collect()] == [0, 0b0110, 0b1111, 0b1101]
