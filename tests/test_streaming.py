from __future__ import annotations

import os
import uuid
from datetime import timedelta

import pytest
from builders import NOON, listing, listings, write_file

from shelflake.sinks import write_partitioned
from shelflake.sinks.warehouse import Warehouse
from shelflake.sources import read_organized
from shelflake.streaming import load_new_files, organize_new_drops


def forget_commit(checkpoint, batch: int) -> None:
    """As if the driver had died after the batch's output and before its commit."""
    for name in (f"{batch}", f".{batch}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")


class Load:
    def __init__(self, spark, tmp_path):
        self.spark = spark
        self.lake, self.checkpoint = (str(tmp_path / name) for name in ("lake", "checkpoint"))
        self.warehouse = Warehouse(f"w_{uuid.uuid4().hex}", str(tmp_path / "warehouse"))

    def add(self, day: int, *asins) -> None:
        rows = [listing(asin=a, fetch_timestamp=NOON + timedelta(days=day)) for a in asins]
        write_partitioned(listings(self.spark, rows), self.lake)

    def run(self, **options) -> list[str]:
        query = load_new_files(self.spark, self.lake, self.warehouse, self.checkpoint, **options)
        query.awaitTermination()
        return sorted(r.asin for r in self.spark.table(self.warehouse.table).collect())


@pytest.fixture
def load(spark, tmp_path):
    return Load(spark, tmp_path)


def test_only_new_files_are_loaded(load):
    load.add(0, "a", "b")
    assert load.run() == ["a", "b"]
    assert load.run() == ["a", "b"]
    load.add(1, "c")
    assert load.run() == ["a", "b", "c"]


def test_a_backlog_in_several_batches_is_loaded_whole(load, spark):
    for day, asin in enumerate("abcde"):
        load.add(day, asin)
    assert load.run(files_per_batch=2) == list("abcde")
    assert len(os.listdir(f"{load.checkpoint}/commits")) == 6  # and a checksum for each


def test_a_repeated_batch_adds_nothing(load):
    load.add(0, "a", "b")
    load.run()
    load.add(1, "c")
    load.run()
    forget_commit(load.checkpoint, 1)
    assert load.run() == ["a", "b", "c"]


def test_rejected_rows_are_kept(load, spark):
    load.add(0, "a", None)
    assert load.run() == ["a"]
    rejects = spark.read.parquet(load.warehouse.rejects)
    assert [r.violations for r in rejects.collect()] == ["asin is missing"]


def test_a_day_that_was_written_again_is_there_once(load, spark):
    load.add(0, "a", "b")
    load.run()
    load.add(0, "c", "d", None)
    assert load.run() == ["c", "d"]
    keys = [r.unique_id for r in spark.table(load.warehouse.table).collect()]
    assert len(set(keys)) == 2


def test_a_file_far_older_than_any_limit_is_loaded(load):
    load.add(0, "a")
    load.run()
    load.add(1, "b")
    long_ago = 1_000_000_000  # 2001
    for folder, _, files in os.walk(load.lake):
        for name in files:
            if "day=02" in folder:
                os.utime(os.path.join(folder, name), (long_ago, long_ago))
    assert load.run() == ["a", "b"]


class Organize:
    def __init__(self, spark, tmp_path):
        self.spark, self.flat = spark, tmp_path / "flat"
        self.target, self.rejects, self.checkpoint, self.archive = (
            str(tmp_path / name) for name in ("organized", "rejects", "checkpoint", "archive")
        )

    def add(self, name: str, *ranks) -> None:
        write_file(self.flat / f"{name}.parquet", [listing(rank=rank) for rank in ranks])

    def run(self, **options) -> list[tuple]:
        query = organize_new_drops(
            self.spark, str(self.flat), self.target, self.checkpoint,
            rejects_root=self.rejects, **options,
        )
        query.awaitTermination()
        return self.found()

    def found(self) -> list[tuple]:
        rows = read_organized(self.spark, self.target).collect()
        return sorted((r.category, r.file_key, r.rank) for r in rows)

    def left_over(self) -> list[tuple]:
        rows = self.spark.read.parquet(self.rejects).collect()
        return sorted((r.reason, r.file_key, r.rank) for r in rows)


@pytest.fixture
def drops(spark, tmp_path):
    return Organize(spark, tmp_path)


A, B = "amazonbestsellers_a_20240101", "amazonbestsellers_b b_20240101"


def test_new_drops_are_organized_once(drops):
    drops.add(A, 1, 2)
    drops.add("amazonbestsellers_none_20240101")
    first = [("a", A, 1), ("a", A, 2)]
    assert drops.run() == first
    assert drops.run() == first
    drops.add(B, 3)
    assert drops.run() == first + [("b b", B, 3)]


def test_left_over_rows_are_kept_by_reason(drops):
    drops.add(A, 1)
    drops.run()
    os.makedirs(drops.flat / f"snapshot_key={A}")
    write_file(drops.flat / f"snapshot_key={A}" / "part-0.parquet", [listing(rank=9)])
    drops.add("amazonbestsellers", 4)
    assert drops.run() == [("a", A, 1)]
    assert drops.left_over() == [("already_organized", A, 9), ("no_category", "amazonbestsellers", 4)]


def test_a_repeated_batch_is_the_same_batch(drops):
    """Its own output must not pass for drops that were organized before."""
    drops.add(A, 1)
    drops.run()
    drops.add(B, 2)
    drops.add("amazonbestsellers", 4)
    before = drops.run()
    forget_commit(drops.checkpoint, 1)
    assert drops.run() == before == [("a", A, 1), ("b b", B, 2)]
    assert drops.left_over() == [("no_category", "amazonbestsellers", 4)]


@pytest.mark.parametrize("clean_source", ["archive", "delete"])
def test_sources_are_retired_by_a_later_run(drops, clean_source):
    options = {"clean_source": clean_source}
    if clean_source == "archive":
        options["archive_root"] = drops.archive
    drops.add(A, 1)
    drops.run(**options)
    drops.add(B, 2)
    drops.run(**options)
    drops.add("amazonbestsellers_c_20240101", 3)
    assert len(drops.run(**options)) == 3
    left = {name for name in os.listdir(drops.flat) if not name.startswith(".")}
    assert f"{A}.parquet" not in left
    archived = [name for _, _, names in os.walk(drops.archive) for name in names]
    assert (f"{A}.parquet" in archived) == (clean_source == "archive")


def test_a_file_with_an_old_date_is_not_passed_over(drops):
    drops.add(A, 1)
    drops.run()
    drops.add(B, 2)
    os.utime(drops.flat / f"{B}.parquet", (1_600_000_000, 1_600_000_000))
    assert drops.run() == [("a", A, 1), ("b b", B, 2)]


def retired(drops, how) -> dict:
    return {"clean_source": how} | ({"archive_root": drops.archive} if how == "archive" else {})


@pytest.mark.parametrize("how", ["archive", "delete"])
def test_sources_are_retired_by_the_run_that_organized_them(drops, how):
    drops.add(A, 1, 2)
    drops.add("amazonbestsellers", 4)
    folder = drops.flat / f"snapshot_key={B}"
    for n in range(2):
        write_file(folder / f"part-{n}.parquet", [listing(rank=n)])
    expected = sorted([("a", A, 1), ("a", A, 2), ("b b", B, 0), ("b b", B, 1)])
    assert drops.run(**retired(drops, how)) == expected
    assert drops.left_over() == [("no_category", "amazonbestsellers", 4)]
    left = [name for _, _, names in os.walk(drops.flat) for name in names if name.endswith(".parquet")]
    assert left == []
    archived = sorted(
        os.path.relpath(os.path.join(at, name), drops.archive)
        for at, _, names in os.walk(drops.archive)
        for name in names
        if name.endswith(".parquet")
    )
    inside = [f"snapshot_key={B}/part-{n}.parquet" for n in range(2)]
    assert archived == (sorted([f"{A}.parquet", "amazonbestsellers.parquet", *inside]) if how == "archive" else [])


@pytest.mark.parametrize("how", ["archive", "delete"])
@pytest.mark.parametrize("loses", ["organized", "left over"])
def test_a_short_target_keeps_the_sources(drops, monkeypatch, how, loses):
    from shelflake.streaming import organize as module

    drops.add(A, 1, 2)
    drops.add("amazonbestsellers", 4, 5)
    with monkeypatch.context() as patch, pytest.raises(Exception, match="not retired"):
        if loses == "organized":
            write = module.write_organized
            patch.setattr(module, "write_organized", lambda rows, root: write(rows.where("rank < 2"), root))
        else:
            write = module.write_left_over
            patch.setattr(module, "write_left_over", lambda rows, *a: write(rows.where("rank < 5"), *a))
        drops.run(**retired(drops, how))
    assert {p.name for p in drops.flat.glob("*.parquet")} == {f"{A}.parquet", "amazonbestsellers.parquet"}
    # The next run repeats the batch, and all is well.
    assert drops.run(**retired(drops, how)) == [("a", A, 1), ("a", A, 2)]
    assert len(drops.left_over()) == 2
    assert list(drops.flat.glob("*.parquet")) == []


@pytest.mark.parametrize("how", ["archive", "delete"])
def test_a_run_that_stopped_while_it_retired(drops, monkeypatch, how):
    """The batch is repeated when some of its sources are gone: what it wrote must stay whole."""
    from shelflake.streaming import organize as module

    folder = drops.flat / f"snapshot_key={B}"
    for n in range(3):
        write_file(folder / f"part-{n}.parquet", [listing(rank=n)])
    name = "remove_folder" if how == "delete" else "renamed"
    step, calls = getattr(module, name), []

    def stops(spark, path, *more):
        if path.startswith("file:") and "/flat/" in path or "/flat/" in path:
            calls.append(path)
            if len(calls) == 2:
                raise RuntimeError("lost")
        return step(spark, path, *more)

    with monkeypatch.context() as patch, pytest.raises(Exception, match="lost"):
        patch.setattr(module, name, stops)
        drops.run(**retired(drops, how))
    assert len(list(folder.glob("*.parquet"))) == 2
    expected = [("b b", B, n) for n in range(3)]
    assert drops.run(**retired(drops, how)) == expected
    assert drops.run(**retired(drops, how)) == expected
    assert list(folder.glob("*.parquet")) == []


def test_a_committed_batch_that_is_repeated_after_its_sources_are_gone(drops):
    drops.add(A, 1)
    drops.run(clean_source="delete")
    forget_commit(drops.checkpoint, 0)
    drops.add(B, 2)
    assert drops.run(clean_source="delete") == [("a", A, 1), ("b b", B, 2)]


def test_options_of_retirement(drops):
    drops.add(A, 1)
    with pytest.raises(ValueError, match="unknown clean_source"):
        drops.run(clean_source="burn")
    with pytest.raises(ValueError, match="archive_root"):
        drops.run(clean_source="archive")
