"""A day changes in one step: loads that stop anywhere leave the old day or the new one."""

from __future__ import annotations

import os
import uuid
from datetime import date, timedelta

import pytest
from builders import NOON, listing, listings

from shelflake.files import names_in, remove_folder
from shelflake.partitions import add_partitions, drop_partitions, partition_folders, point_partitions
from shelflake.plans import load_day
from shelflake.sinks import remove_left_over, warehouse as sink, write_partitioned
from shelflake.sinks.warehouse import KEYS, Warehouse, create_table, publish_version, reserve_ids

DAY = date(2024, 1, 1)


class Stopped(Exception):
    pass


def rows_of(spark, *per_category, day=DAY):
    """(category, price, asins) of one day."""
    at = NOON + timedelta(days=(day - DAY).days)
    frames = [
        listings(spark, [listing(asin=a, product_price=price, fetch_timestamp=at) for a in asins], category)
        for category, price, asins in per_category
    ]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(f"w_{uuid.uuid4().hex}", str(tmp_path / "warehouse"))


@pytest.fixture
def lakes(spark, tmp_path):
    """The lake before and after: a category that changes, one that goes, one that comes, and one of nothing
    but rejects afterwards.
    """
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    write_partitioned(rows_of(spark, ("a", "$1", "xy"), ("b:%c", "$1", "z"), ("r", "$1", "w")), old)
    write_partitioned(rows_of(spark, ("a", "$2", "x"), ("d e", "$2", "uv"), ("r", "$2", [None])), new)
    return old, new


OLD = [("a", "x", "1.00"), ("a", "y", "1.00"), ("b:%c", "z", "1.00"), ("r", "w", "1.00")]
NEW = [("a", "x", "2.00"), ("d e", "u", "2.00"), ("d e", "v", "2.00")]


def found(spark, warehouse):
    rows = spark.table(warehouse.table).collect()
    return sorted((r.category, r.asin, str(r.product_price)) for r in rows)


def stop(monkeypatch, name, after):
    """The named step of publishing stops the run, before or after it is done."""
    done = getattr(sink, name)

    def step(*args, **options):
        if after:
            done(*args, **options)
        raise Stopped

    monkeypatch.setattr(sink, name, step)


STEPS = ["_complete", "_announce", "point_partitions", "_forget", "_retire"]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("name", STEPS)
def test_a_run_stopped_at_any_step(spark, lakes, warehouse, name, after):
    old, new = lakes
    load_day(spark, old, warehouse, day=DAY, mode="replace_day")
    assert found(spark, warehouse) == OLD
    switched = STEPS.index(name) + after > STEPS.index("point_partitions")
    with pytest.MonkeyPatch.context() as patch, pytest.raises(Stopped):
        stop(patch, name, after)
        load_day(spark, new, warehouse, day=DAY, mode="replace_day")
    assert found(spark, warehouse) == (NEW if switched else OLD)

    # What a new catalog finds is whole as well.
    again = Warehouse(warehouse.table + "_again", warehouse.root)
    create_table(spark, again)
    assert found(spark, again) in (OLD, NEW)

    load_day(spark, new, warehouse, day=DAY, mode="replace_day")
    assert found(spark, warehouse) == NEW
    remove_left_over(spark, warehouse)
    assert found(spark, warehouse) == NEW
    assert remove_left_over(spark, warehouse) == 0
    # One version is left, and in it the partitions and the folders that stand for emptied ones.
    assert len([n for n in names_in(spark, warehouse.versions) if n.isdigit()]) == 1
    keys = [r.unique_id for r in spark.table(warehouse.table).collect()]
    assert len(set(keys)) == len(keys)


def test_a_run_stopped_while_it_writes(spark, lakes, warehouse, monkeypatch):
    old, new = lakes
    load_day(spark, old, warehouse, day=DAY)
    number = reserve_ids(spark, warehouse, 5)
    half = f"{warehouse.versions}/{number + 1:020d}/snapshot_day=20240101/category=a"
    os.makedirs(half)
    spark.table(warehouse.table).limit(1).drop(*KEYS).write.mode("append").parquet(half)
    again = Warehouse(warehouse.table + "_again", warehouse.root)
    create_table(spark, again)
    assert found(spark, warehouse) == found(spark, again) == OLD
    assert remove_left_over(spark, warehouse) == 1
    assert found(spark, warehouse) == found(spark, again) == OLD


def test_a_stop_before_the_rejects_is_made_good(spark, lakes, warehouse, monkeypatch):
    from shelflake.plans import load

    old, new = lakes
    load_day(spark, old, warehouse, day=DAY)

    def stopped(*args):
        raise Stopped

    with monkeypatch.context() as patch, pytest.raises(Stopped):
        patch.setattr(load, "_replace_rejects", stopped)
        load_day(spark, new, warehouse, day=DAY, mode="replace_day")
    assert found(spark, warehouse) == NEW
    load_day(spark, new, warehouse, day=DAY, mode="replace_day")
    assert found(spark, warehouse) == NEW
    assert spark.read.parquet(warehouse.rejects).count() == 1


@pytest.mark.parametrize("how", ["vanished", "empty", "no lake"])
def test_a_day_without_rows_is_emptied(spark, lakes, warehouse, tmp_path, how):
    lake = str(tmp_path / "lake")
    other = DAY + timedelta(1)
    write_partitioned(rows_of(spark, ("a", "$1", ["x", None]), ("b", "$1", "y")), lake)
    write_partitioned(rows_of(spark, ("a", "$1", ["q", None]), day=other), lake)
    for day in (DAY, other):
        load_day(spark, lake, warehouse, day=day)
    day_folders = [f"{lake}/category={c}/year=2024/month=01/day=01" for c in "ab"]
    for folder in day_folders:
        remove_folder(spark, folder)
    if how == "empty":
        rows_of(spark, ("a", "$1", "x")).drop("category").limit(0).write.parquet(day_folders[0])
    if how == "no lake":
        lake = str(tmp_path / "nowhere")
    result = load_day(spark, lake, warehouse, day=DAY, mode="replace_day")
    assert (result.rows_read, result.rows_loaded) == (0, 0)
    assert found(spark, warehouse) == [("a", "q", "1.00")]
    rejects = spark.read.schema("snapshot_day string").parquet(warehouse.rejects)
    assert [r.snapshot_day for r in rejects.collect()] == ["20240102"]
    # A new catalog does not bring it back.
    again = Warehouse(warehouse.table + "_again", warehouse.root)
    create_table(spark, again)
    assert found(spark, again) == [("a", "q", "1.00")]


def test_named_categories_follow_the_lakes_folders(spark, warehouse, tmp_path):
    """A named category with a folder of no rows is emptied; one that the lake does not have stays."""
    lake = str(tmp_path / "lake")
    write_partitioned(rows_of(spark, ("a", "$1", "x"), ("b", "$1", "y"), ("c", "$1", "z")), lake)
    load_day(spark, lake, warehouse, day=DAY)
    for c in "ab":
        remove_folder(spark, f"{lake}/category={c}/year=2024/month=01/day=01")
    empty = rows_of(spark, ("a", "$1", "x")).drop("category").limit(0)
    empty.write.parquet(f"{lake}/category=a/year=2024/month=01/day=01")
    load_day(spark, lake, warehouse, day=DAY, categories=["a", "b"], mode="replace_day")
    assert found(spark, warehouse) == [("b", "y", "1.00"), ("c", "z", "1.00")]


def test_appending_to_some_categories_and_adding_others(spark, warehouse, tmp_path):
    lake, other = str(tmp_path / "lake"), str(tmp_path / "other")
    write_partitioned(rows_of(spark, ("a", "$1", "x"), ("", "$1", "n")), lake)
    write_partitioned(rows_of(spark, ("a", "$2", "y"), ("b", "$2", "z"), ("", "$2", "m")), other)
    load_day(spark, lake, warehouse, day=DAY)
    load_day(spark, other, warehouse, day=DAY)
    rows = spark.table(warehouse.table).collect()
    assert sorted((r.category or "", r.asin) for r in rows) == [("", "m"), ("", "n"), ("a", "x"), ("a", "y"), ("b", "z")]
    assert sorted(r.unique_id for r in rows) == [1, 2, 3, 4, 5]
    load_day(spark, other, warehouse, day=DAY, mode="replace_day")
    assert sorted(r.asin for r in spark.table(warehouse.table).collect()) == ["m", "y", "z"]


def test_a_day_in_the_tables_own_place_is_replaced(spark, warehouse, tmp_path):
    """As loads of earlier releases have left it."""
    lake = str(tmp_path / "lake")
    write_partitioned(rows_of(spark, ("a", "$1", "xy")), lake)
    load_day(spark, lake, warehouse, day=DAY)
    spark.table(warehouse.table).write.partitionBy(*KEYS).parquet(f"{tmp_path}/early/rows")
    early = Warehouse(warehouse.table + "_early", f"{tmp_path}/early")
    create_table(spark, early)
    assert found(spark, early) == [("a", "x", "1.00"), ("a", "y", "1.00")]
    write_partitioned(rows_of(spark, ("a", "$2", "z")), lake)
    load_day(spark, lake, early, day=DAY, mode="replace_day")
    assert found(spark, early) == [("a", "z", "2.00")]
    assert names_in(spark, f"{early.rows}/snapshot_day=20240101") == []


def test_all_partitions_change_in_one_call(spark, warehouse, monkeypatch):
    """A hundred and fifty categories of two days."""
    create_table(spark, warehouse)
    keys = [(d, f"c'{n}") for d in ("20240101", "20240102") for n in range(75)]
    made = spark.createDataFrame([(d, c, n) for n, (d, c) in enumerate(keys)], "snapshot_day string, category string, unique_id bigint")
    rows = made
    for name, kind in spark.table(warehouse.table).dtypes:
        if name not in made.columns:
            rows = rows.selectExpr("*", f"CAST(NULL AS {kind}) AS {name}")
    publish_version(spark, warehouse, 1, rows, set(keys))
    assert spark.table(warehouse.table).count() == 150
    publish_version(spark, warehouse, 2, rows.where("unique_id < 5"), set(keys))
    assert sorted(r.unique_id for r in spark.table(warehouse.table).collect()) == list(range(5))
    assert len(partition_folders(spark, warehouse.table, KEYS)) == 5


def test_partition_statements(spark, tmp_path):
    table = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} (x BIGINT, d STRING, c STRING) USING parquet PARTITIONED BY (d, c) LOCATION '{tmp_path}/t'")
    spark.range(3).selectExpr("id AS x").write.parquet(f"{tmp_path}/it's")
    os.makedirs(tmp_path / "none")
    add_partitions(spark, table, ("d", "c"), [("1", "a'\\b"), ("1", "c"), ("2", "c")], f"{tmp_path}/none")
    add_partitions(spark, table, ("d", "c"), [("1", "c")])
    point_partitions(spark, table, ("d", "c"), {("1", "a'\\b"): f"{tmp_path}/it's", ("3", "x"): "nowhere"})
    assert sorted(map(tuple, spark.table(table).collect())) == [(n, "1", "a'\\b") for n in range(3)]
    assert set(partition_folders(spark, table, ("d", "c"), {"d": "1"})) == {("1", "a'\\b"), ("1", "c")}
    drop_partitions(spark, table, ("d", "c"), [("1", "a'\\b"), ("9", "9")])
    assert spark.table(table).count() == 0
    assert len(partition_folders(spark, table, ("d", "c"))) == 2


# --- keys ------------------------------------------------------------------------


def test_a_claim_is_one_name(spark, warehouse):
    create_table(spark, warehouse)
    lasts = [reserve_ids(spark, warehouse, 3) for _ in range(20)]
    assert lasts == list(range(0, 60, 3))
    assert [n for n in names_in(spark, warehouse.reserved) if not n.startswith(".")] == ["58-60"]


def test_a_driver_lost_right_after_its_claim(spark, lakes, warehouse, monkeypatch):
    """Its keys are a gap; the next load goes on behind them and does not wait."""
    create_table(spark, warehouse)
    rename = sink.renamed

    def lost(*args):
        rename(*args)
        raise Stopped

    with monkeypatch.context() as patch, pytest.raises(Stopped):
        patch.setattr(sink, "renamed", lost)
        reserve_ids(spark, warehouse, 7)
    # The first of the two renames has put the folder there; a second loss is behind the claim itself.
    assert reserve_ids(spark, warehouse, 2) == 0
    with monkeypatch.context() as patch, pytest.raises(Stopped):
        patch.setattr(sink, "renamed", lost)
        reserve_ids(spark, warehouse, 7)
    assert reserve_ids(spark, warehouse, 1) == 9
    load_day(spark, lakes[0], warehouse, day=DAY)
    assert sorted(r.unique_id for r in spark.table(warehouse.table).collect()) == [11, 12, 13, 14]


def test_a_load_that_comes_late_to_the_first_claim(spark, warehouse, monkeypatch):
    """It saw no folder; by the time it makes one, others have claimed keys."""
    create_table(spark, warehouse)
    start = sink._start_keys

    def late(*args):
        monkeypatch.setattr(sink, "_start_keys", start)
        assert reserve_ids(spark, warehouse, 5) == 0
        start(*args)

    monkeypatch.setattr(sink, "_start_keys", late)
    assert reserve_ids(spark, warehouse, 4) == 5
    assert [n for n in names_in(spark, warehouse.reserved) if not n.startswith(".")] == ["6-9"]


def test_a_load_that_is_overtaken_claims_behind(spark, warehouse, monkeypatch):
    create_table(spark, warehouse)
    reserve_ids(spark, warehouse, 1)
    rename = sink.renamed

    def overtaken(*args):
        monkeypatch.setattr(sink, "renamed", rename)
        assert reserve_ids(spark, warehouse, 5) == 1
        return rename(*args)

    monkeypatch.setattr(sink, "renamed", overtaken)
    assert reserve_ids(spark, warehouse, 4) == 6
