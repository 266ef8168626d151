from __future__ import annotations

import importlib

import pytest
from builders import listing, listings, write_file
from pyspark.sql import functions as F

from shelflake.files import remove_folder
from shelflake.operators import files_behind, rows_of_files
from shelflake.plans import OrganizeResult, organize
from shelflake.sinks import write_flat, write_organized
from shelflake.sources import drop_files, organized_keys, read_flat, read_organized
from shelflake.sources.flat import scan_flat
from shelflake.sources import organized
from shelflake.sources.listing import kept
from shelflake.sources.organized import close_days, compact_manifest

EMPTY = "amazonbestsellers_empty_20240101"
KITCHEN = "amazonbestsellers_kitchen_20240101"
ODD = "amazonbestsellers_kit chen+50%_20240101"


@pytest.fixture
def flat(tmp_path):
    folder = tmp_path / "flat"
    write_file(folder / f"{KITCHEN}.parquet", [listing(rank=n) for n in (1, 2)])
    write_file(folder / f"{ODD}.parquet", [listing(rank=3)])
    write_file(folder / "amazonbestsellers_empty_20240101.parquet", [])
    write_file(folder / "amazonbestsellers.parquet", [listing(rank=4)])
    write_file(folder / "unrelated_kitchen_20240101.parquet", [listing(rank=5)])
    return folder


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "organized")


def found(spark, target):
    rows = read_organized(spark, target).collect()
    return sorted((r.category, r.file_key, r.rank) for r in rows)


ORGANIZED = sorted([("kitchen", KITCHEN, 1), ("kitchen", KITCHEN, 2), ("kit chen+50%", ODD, 3)])


def test_lineage_of_single_files(spark, flat):
    rows = {r.rank: r for r in read_flat(spark, str(flat)).collect()}
    assert set(rows) == {1, 2, 3, 4}
    assert rows[1].filename == f"{KITCHEN}.parquet"
    assert rows[1].file_path.endswith(f"/flat/{KITCHEN}.parquet")
    assert (rows[3].file_key, rows[3].category) == (ODD, "kit chen+50%")
    assert (rows[4].file_key, rows[4].category) == ("amazonbestsellers", "")


def test_the_listing_also_shows_files_without_rows(spark, flat):
    listed = {r.file_key for r in drop_files(spark, str(flat)).collect()}
    seen = {r.file_key for r in files_behind(scan_flat(spark, str(flat))).collect()}
    assert listed - seen == {"amazonbestsellers_empty_20240101"}


def test_organize(spark, flat, target, tmp_path):
    rejects = str(tmp_path / "rejects")
    result = organize(spark, str(flat), target, rejects_root=rejects)
    assert result == OrganizeResult(organized=3, skipped=0, unmatched=1)
    assert found(spark, target) == ORGANIZED
    assert [(r.file_key, r.rank) for r in spark.read.parquet(rejects).collect()] == [
        ("amazonbestsellers", 4)
    ]
    # Nothing new the second time, the file without rows included.
    again = organize(spark, str(flat), target, rejects_root=rejects)
    assert again == OrganizeResult(organized=0, skipped=3, unmatched=1)
    assert found(spark, target) == ORGANIZED
    assert spark.read.parquet(rejects).count() == 1


def test_existing_folders_are_left_alone(spark, flat, target):
    organize(spark, str(flat), target)
    write_file(flat / f"{KITCHEN}.parquet", [listing(rank=99)])
    write_file(flat / "amazonbestsellers_software_20240101.parquet", [listing(rank=6)])
    result = organize(spark, str(flat), target)
    assert (result.organized, result.skipped) == (1, 3)
    assert found(spark, target) == sorted(
        ORGANIZED + [("software", "amazonbestsellers_software_20240101", 6)]
    )


def test_keys_are_read_from_folder_names(spark, flat, target):
    organize(spark, str(flat), target)
    keys = {tuple(r) for r in organized_keys(spark, target).collect()}
    assert keys == {("kitchen", KITCHEN), ("kit chen+50%", ODD), ("empty", EMPTY)}


def test_names_that_look_like_patterns(spark, tmp_path, target):
    name = "amazonbestsellers_a[b]{c}_20240101"
    write_file(tmp_path / "flat" / f"{name}.parquet", [listing(rank=1)])
    write_file(tmp_path / "flat" / f"{KITCHEN}.parquet", [listing(rank=2)])
    organize(spark, str(tmp_path / "flat"), target)
    assert found(spark, target) == [("a[b]{c}", name, 1), ("kitchen", KITCHEN, 2)]


def test_folder_drops_of_the_flat_sink(spark, tmp_path, target):
    flat = str(tmp_path / "flat")
    write_flat(listings(spark, [listing(rank=1)], "a:b"), flat)
    write_flat(listings(spark, [listing(rank=2)]), flat)
    organize(spark, flat, target)
    assert found(spark, target) == [
        ("a:b", "amazonbestsellers_a:b_20240101", 1), ("kitchen", KITCHEN, 2),
    ]


def test_a_listing_takes_a_task_per_core_and_not_per_file(spark, tmp_path):
    for n in range(30):
        write_file(tmp_path / "flat" / f"amazonbestsellers_c{n}_20240101.parquet", [listing()])
    settings = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "0"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        files = drop_files(spark, str(tmp_path / "flat"))
        assert files.rdd.getNumPartitions() == 30
        with kept(files) as listed:
            assert listed.select("file_uri").rdd.getNumPartitions() <= 8
            assert listed.count() == 30
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1000"
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_empty_places(spark, tmp_path, target):
    assert organize(spark, str(tmp_path / "none"), target) == OrganizeResult(0, 0, 0)
    assert read_organized(spark, target).isEmpty()


def test_a_small_drop_stays_one_file(spark, flat, target):
    organize(spark, str(flat), target)
    assert len(read_organized(spark, target).inputFiles()) == 2


def test_a_hot_drop_is_written_by_many_tasks(spark, tmp_path, target):
    """One drop holds most rows: its folder gets a file per split, with every row once."""
    flat = tmp_path / "flat"
    hot = [listing(rank=n, product_title=f"title {n}" * 9) for n in range(20_000)]
    write_file(flat / f"{KITCHEN}.parquet", hot, row_group_size=1_000)
    write_file(flat / "amazonbestsellers_b_20240101.parquet", [listing(rank=-1)])
    setting = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(setting, str((flat / f"{KITCHEN}.parquet").stat().st_size // 5))
    try:
        organize(spark, str(flat), target)
    finally:
        spark.conf.unset(setting)
    back = read_organized(spark, target)
    assert sum("category=kitchen/" in path for path in back.inputFiles()) >= 4
    assert sorted(r.rank for r in back.select("rank").collect()) == [-1, *range(20_000)]


def test_the_number_of_jobs_does_not_grow_with_the_drops(spark, tmp_path, count_jobs):
    counts = []
    for drops in (2, 25):
        flat = tmp_path / f"flat{drops}"
        for n in range(drops):
            write_file(flat / f"amazonbestsellers_c{n}_20240101.parquet", [listing(rank=n)])
        counts.append(
            count_jobs(lambda: organize(spark, str(flat), str(tmp_path / f"out{drops}")))
        )
        assert len(found(spark, str(tmp_path / f"out{drops}"))) == drops
    assert counts[1] <= counts[0] + 2


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_rows_of_files_with_and_without_broadcast(spark, flat, threshold):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, threshold)
    scan = scan_flat(spark, str(flat))
    files = drop_files(spark, str(flat)).where(F.col("category") == "kitchen")
    try:
        assert sorted(r.rank for r in rows_of_files(scan, files).collect()) == [1, 2]
    finally:
        spark.conf.set(setting, before)


def test_organizing_shuffles_no_rows(spark, flat):
    scan = scan_flat(spark, str(flat))
    plan = rows_of_files(scan, drop_files(spark, str(flat)))._jdf.queryExecution().executedPlan()
    rows_side = plan.toString().split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in rows_side


def test_a_run_does_not_list_the_tree(spark, flat, target, monkeypatch):
    from shelflake.sources import organized

    organize(spark, str(flat), target)
    monkeypatch.setattr(organized, "listed_keys", lambda *a: pytest.fail("the tree was listed"))
    assert organize(spark, str(flat), target).organized == 0


def test_a_run_that_ended_half_way_is_done_again(spark, flat, target, monkeypatch):
    module = importlib.import_module("shelflake.plans.organize")

    organize(spark, str(flat), target)
    write_file(flat / "amazonbestsellers_late_20240103.parquet", [listing(rank=7)])
    with monkeypatch.context() as patch:
        patch.setattr(module, "record_organized", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            organize(spark, str(flat), target)
    assert organize(spark, str(flat), target).organized == 1
    assert found(spark, target).count(("late", "amazonbestsellers_late_20240103", 7)) == 1


def test_a_manifest_of_many_runs_is_compacted(spark, flat, target):
    organize(spark, str(flat), target)
    compact_manifest(spark, target)
    assert organize(spark, str(flat), target).organized == 0


def test_folder_drops_of_other_writers(spark, tmp_path, target):
    name = "amazonbestsellers_a_20240101"
    rows = listings(spark, [listing(rank=n) for n in range(3)]).drop("category")
    rows.repartition(3).write.parquet(str(tmp_path / "flat" / f"{name}.parquet"))
    assert organize(spark, str(tmp_path / "flat"), target).organized == 1
    assert found(spark, target) == [("a", name, n) for n in range(3)]


def test_a_prefix_that_looks_like_a_pattern(spark, tmp_path, target):
    write_file(tmp_path / "flat" / "best[1]_a_20240101.parquet", [listing(rank=1)])
    write_file(tmp_path / "flat" / "best1_b_20240101.parquet", [listing(rank=2)])
    organize(spark, str(tmp_path / "flat"), target, prefix="best[1]")
    assert found(spark, target) == [("a", "best[1]_a_20240101", 1)]


# --- the manifest ------------------------------------------------------------


def many_keys(spark, count):
    return spark.range(count).select(
        F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("category"),
        F.concat(F.lit("drop "), F.col("id").cast("string")).alias("file_key"),
    )


def all_keys(spark, target):
    return {tuple(r) for r in organized_keys(spark, target).collect()}


@pytest.fixture
def stored(spark, target, monkeypatch):
    monkeypatch.setattr(organized, "KEYS_PER_BUCKET", 10)
    write_organized(listings(spark, [listing()]).withColumn("file_key", F.lit("x")), target)
    organized.record_organized(many_keys(spark, 200), target)
    compact_manifest(spark, target)
    return target


def bytes_read(spark, frame):
    import os
    from urllib.parse import urlparse

    return sum(os.path.getsize(urlparse(path).path) for path in frame.inputFiles())


def test_only_the_buckets_of_the_drops_are_read(spark, stored):
    drops = many_keys(spark, 203).where("CAST(substr(file_key, 6) AS INT) > 197")
    known = organized_keys(spark, stored, drops)
    assert len(known.inputFiles()) <= 5
    assert drops.join(known, ["category", "file_key"]).count() == 2
    assert drops.join(known, ["category", "file_key"], "left_anti").count() == 3
    assert all_keys(spark, stored) == {tuple(r) for r in many_keys(spark, 200).collect()}


def test_bytes_read_do_not_grow_with_the_history(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(organized, "KEYS_PER_BUCKET", 100)
    read = []
    for count in (500, 5000):
        target = str(tmp_path / f"t{count}")
        organized.record_organized(many_keys(spark, count), target)
        compact_manifest(spark, target)
        drops = many_keys(spark, count).limit(3)
        read.append(bytes_read(spark, organized_keys(spark, target, drops)))
    assert 0 < read[1] < 1.5 * read[0]


@pytest.mark.parametrize("step", ["mark", "remove_folder"])
def test_a_compaction_that_stops_loses_no_key(spark, stored, monkeypatch, step):
    from shelflake import generations

    before = all_keys(spark, stored)
    organized.record_organized(many_keys(spark, 230), stored)
    expected = before | {tuple(r) for r in many_keys(spark, 230).collect()}

    def stop(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(generations if step == "mark" else organized, step, stop)
        compact_manifest(spark, stored)
    assert all_keys(spark, stored) == expected
    compact_manifest(spark, stored)
    assert all_keys(spark, stored) == expected


def test_keys_added_during_a_compaction_stay(spark, stored, monkeypatch):
    write = organized.write_generation

    def meanwhile(*args, **options):
        organized.record_organized(many_keys(spark, 201), stored)
        return write(*args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(organized, "write_generation", meanwhile)
        compact_manifest(spark, stored)
    assert len(all_keys(spark, stored)) == 201
    compact_manifest(spark, stored)
    assert len(all_keys(spark, stored)) == 201


def test_a_drop_without_rows_stays_known(spark, flat, target):
    organize(spark, str(flat), target)
    for _ in range(2):
        compact_manifest(spark, target)
        assert ("empty", EMPTY) in all_keys(spark, target)
        assert organize(spark, str(flat), target) == OrganizeResult(0, 3, 1)


def test_a_manifest_of_an_earlier_release(spark, flat, target):
    """Its keys lie in files of the manifest's own folder."""
    organize(spark, str(flat), target)
    keys = organized_keys(spark, target).collect()
    remove_folder(spark, organized.manifest(target))
    spark.createDataFrame(keys, organized.KEY_SCHEMA).write.parquet(organized.manifest(target))
    assert organize(spark, str(flat), target).organized == 0
    compact_manifest(spark, target)
    assert organize(spark, str(flat), target).organized == 0
    assert len(all_keys(spark, target)) == 3


def test_an_empty_manifest(spark, target):
    organized.record_organized(many_keys(spark, 0), target)
    assert all_keys(spark, target) == set()
    compact_manifest(spark, target)
    assert all_keys(spark, target) == set()
    assert organized_keys(spark, target, many_keys(spark, 3)).isEmpty()


# --- closed days -------------------------------------------------------------


def test_names_since_a_day(spark, tmp_path):
    """The patterns against the names they are to match, files and folders."""
    import random
    import re

    source = random.Random(8)
    days = ["20240101", "20240115", "20240114", "20240116", "20231231", "20250101", "20240201", "99991231", "00000000"]
    tails = ["", "x", "1", "_", "20240101", "_2024010", "_202401011", "_a_20240114b", "-20240114", "_kit 2_2024", "_é_2024011é"]
    names = {"best" + t for t in tails} | {f"best_{c}_{d}" for c in ("a", "a_20240101", "é b", "") for d in days}
    names |= {f"best_{''.join(source.choices('_0129a', k=source.randint(1, 12)))}" for _ in range(150)}
    for n, name in enumerate(sorted(names)):
        if n % 2:
            write_file(tmp_path / f"{name}.parquet", [])
        else:
            write_file(tmp_path / f"snapshot_key={name}" / "part-0.parquet", [])
    write_file(tmp_path / "other_a_20240115.parquet", [])
    for since in ("20240115", "20191231", "20240099", "99999999", "00000000"):
        expected = {n for n in names if not re.search("_[0-9]{8}$", n) or n[-8:] >= since}
        found = {r.file_key for r in drop_files(spark, str(tmp_path), "best", since).collect()}
        assert found == expected
    assert {r.file_key for r in drop_files(spark, str(tmp_path), "best").collect()} == names


def test_closed_days_are_not_listed(spark, flat, target, monkeypatch):
    from datetime import date

    write_file(flat / "amazonbestsellers_new_20240105.parquet", [listing(rank=7)])
    assert organize(spark, str(flat), target) == OrganizeResult(4, 0, 1)
    close_days(spark, target, before=date(2024, 1, 5))
    close_days(spark, target, before=date(2024, 1, 2))
    write_file(flat / "amazonbestsellers_late_20240101.parquet", [listing(rank=8)])
    write_file(flat / "amazonbestsellers_next_20240106.parquet", [listing(rank=9)])
    # The days from the fifth on, and the drop that tells no day.
    assert organize(spark, str(flat), target) == OrganizeResult(1, 1, 1)
    assert organize(spark, str(flat), target, all_days=True) == OrganizeResult(1, 5, 1)


def test_days_closed_before_the_first_run(spark, flat, target):
    from datetime import date

    close_days(spark, target, before=date(2024, 1, 2))
    assert organize(spark, str(flat), target) == OrganizeResult(0, 0, 1)
    assert organize(spark, str(flat), target, all_days=True) == OrganizeResult(3, 0, 1)
