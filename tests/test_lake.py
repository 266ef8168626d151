from __future__ import annotations

import uuid
from datetime import date, timedelta

import pytest
from builders import NOON, listing, listings, write_file
from pyspark.sql import functions as F

from shelflake.schema import PARTITIONED_LAKE_SCHEMA
from shelflake.sinks import write_flat, write_partitioned
from shelflake.sources import read_day, read_flat, read_lake, register_lake
from shelflake.sinks.lake import with_lake_keys
from shelflake.sources.lake import add_days, refresh_lake

DAY = date(2024, 1, 2)


@pytest.fixture
def lake(spark, root):
    rows = [listing(rank=n, fetch_timestamp=NOON + timedelta(days=n)) for n in range(4)]
    write_partitioned(listings(spark, rows).unionByName(listings(spark, rows, "software")), root)
    return root


def folders(frame):
    return {path.rsplit("/", 1)[0].split("/data/")[-1] for path in frame.inputFiles()}


def test_a_day_lists_only_its_own_folders(spark, lake):
    day = read_day(spark, lake, day=DAY)
    assert folders(day) == {
        "category=kitchen/year=2024/month=01/day=02",
        "category=software/year=2024/month=01/day=02",
    }
    assert sorted((r.category, r.month, r.rank) for r in day.collect()) == [
        ("kitchen", "01", 1), ("software", "01", 1),
    ]


def test_a_day_of_one_category(spark, lake):
    assert [r.category for r in read_day(spark, lake, day=DAY, categories=["software"]).collect()] == [
        "software"
    ]


def test_missing_day_and_missing_lake_are_empty(spark, lake, root):
    for found in (
        read_day(spark, lake, day=date(2030, 1, 1)),
        read_day(spark, root + "/nowhere", day=DAY),
    ):
        assert found.schema == PARTITIONED_LAKE_SCHEMA
        assert found.isEmpty()


def test_an_unreadable_file_is_an_error(spark, lake, tmp_path):
    broken = tmp_path / "data" / "category=kitchen" / "year=2024" / "month=01" / "day=02"
    (broken / "broken.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_day(spark, lake, day=DAY).collect()


def test_files_of_other_writers_are_read(spark, tmp_path, root):
    place = tmp_path / "data" / "category=kitchen" / "year=2024" / "month=01" / "day=02"
    write_file(place / "amazonbestsellers_kitchen_20240102.parquet", [listing(rank=7)])
    row = read_day(spark, root, day=DAY).first()
    assert (row.rank, row.category, row.month, row.fetch_timestamp) == (7, "kitchen", "01", NOON)


def test_writing_a_day_again_replaces_it_alone(spark, lake):
    again = [listing(rank=n, fetch_timestamp=NOON + timedelta(days=1)) for n in (8, 9)]
    write_partitioned(listings(spark, again), lake)
    ranks = {r[0]: sorted(r[1]) for r in read_lake(spark, lake).groupBy("category", "day").agg(
        F.collect_list("rank").alias("ranks")
    ).select(F.concat("category", "day"), "ranks").collect()}
    assert ranks["kitchen02"] == [8, 9]
    assert ranks["software02"] == [1]
    assert len(ranks) == 8


def test_pruned_columns_and_pushed_filters(spark, lake):
    plan = (
        read_day(spark, lake, day=DAY)
        .where(F.col("product_price").contains("$"))
        .select("asin")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "StringContains(product_price" in plan
    assert "ReadSchema: struct<asin:string,product_price:string>" in plan


def test_a_hot_category_is_split_over_tasks(spark, root):
    """Most rows are one category-day: its rows end up in several files of one folder."""
    hot = spark.range(200_000).select(
        *(F.col("id").cast("string").alias(n) for n in ("asin", "product_title", "product_url")),
        F.col("id").alias("rank"),
        F.lit("$1").alias("product_price"),
        F.lit(1.0).alias("product_star_rating"),
        F.lit(1).cast("bigint").alias("product_num_ratings"),
        F.lit("p").alias("product_photo"),
        F.lit(None).cast("string").alias("rank_change_label"),
        F.lit("2024-01-01 12:00:00").cast("timestamp_ntz").alias("fetch_timestamp"),
        F.when(F.col("id") % 100 == 0, "rare").otherwise("hot").alias("category"),
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "512k")
    try:
        write_partitioned(hot, root)
    finally:
        spark.conf.unset(setting)
    back = read_lake(spark, root)
    assert sum("category=hot/" in path for path in back.inputFiles()) > 2
    assert back.groupBy("category").count().orderBy("category").collect() == [
        ("hot", 198_000), ("rare", 2_000),
    ]


def test_sql_over_the_lake_prunes_and_sees_new_days_after_a_refresh(spark, lake):
    register_lake(spark, "lake_sql_test", lake)
    query = "SELECT asin FROM lake_sql_test WHERE category = 'kitchen' AND month = '01' AND day = '02'"
    assert spark.sql(query).count() == 1
    assert folders(spark.sql(query)) == {"category=kitchen/year=2024/month=01/day=02"}

    late = [listing(fetch_timestamp=NOON + timedelta(days=9))]
    write_partitioned(listings(spark, late), lake)
    days = "SELECT DISTINCT day FROM lake_sql_test"
    assert spark.sql(days).count() == 4
    refresh_lake(spark, "lake_sql_test")
    assert spark.sql(days).count() == 5


def test_registering_an_empty_place(spark, root):
    register_lake(spark, "lake_empty_test", root)
    assert spark.table("lake_empty_test").isEmpty()


def test_flat_layout_replaces_its_key(spark, root):
    write_flat(listings(spark, [listing(rank=1), listing(rank=2)]), root)
    write_flat(listings(spark, [listing(rank=3)]), root)
    rows = read_flat(spark, root).collect()
    assert [(r.rank, r.file_key, r.category) for r in rows] == [
        (3, "amazonbestsellers_kitchen_20240101", "kitchen")
    ]


def test_flat_keys_survive_odd_category_names(spark, root):
    names = ["a:b", "50% off", "x+y", "kit chen", "q=1"]
    for name in names:
        write_flat(listings(spark, [listing()], name), root)
    assert {r.category for r in read_flat(spark, root).collect()} == set(names)


def test_a_table_keeps_its_place(spark, lake, tmp_path):
    table = f"t_{uuid.uuid4().hex}"
    register_lake(spark, table, lake)
    register_lake(spark, table, f"file:{lake}/")
    with pytest.raises(ValueError, match="is registered at"):
        register_lake(spark, table, str(tmp_path / "elsewhere"))


def test_a_written_day_is_added_without_listing_the_lake(spark, lake):
    table = f"t_{uuid.uuid4().hex}"
    register_lake(spark, table, lake)
    before = spark.table(table).count()
    late = listings(spark, [listing(fetch_timestamp=NOON + timedelta(days=300))], "it's new")
    write_partitioned(late, lake)
    assert spark.table(table).count() == before
    add_days(spark, table, with_lake_keys(late))
    assert spark.table(table).count() == before + 1
