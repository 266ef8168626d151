"""The load by ledger."""

from __future__ import annotations

import os
import uuid
from datetime import date, timedelta

import pytest
from builders import NOON, listing, listings

from shelflake.files import names_in, remove_folder
from shelflake.generations import newest_generation, write_generation
from shelflake.partitions import escaped
from shelflake.plans import changes, load_changed_days
from shelflake.sinks import write_partitioned
from shelflake.sinks.warehouse import Warehouse
from shelflake.sources.lake import read_category_days, register_lake
from shelflake.sources.ledger import listed_month, months


class Load:
    def __init__(self, spark, tmp_path):
        self.spark = spark
        self.lake, self.ledger = str(tmp_path / "lake"), str(tmp_path / "ledger")
        self.warehouse = Warehouse(f"w_{uuid.uuid4().hex}", str(tmp_path / "warehouse"))

    def add(self, day: int, *asins, category="kitchen") -> None:
        rows = [listing(asin=a, fetch_timestamp=NOON + timedelta(days=day)) for a in asins]
        write_partitioned(listings(self.spark, rows, category), self.lake)

    def run(self, **options):
        return load_changed_days(self.spark, self.lake, self.warehouse, self.ledger, **options)

    def found(self) -> list[str]:
        return sorted(r.asin for r in self.spark.table(self.warehouse.table).collect())


@pytest.fixture
def load(spark, tmp_path):
    return Load(spark, tmp_path)


def test_only_what_has_changed_is_loaded(load):
    load.add(0, "a", "b")
    load.add(0, "k", category="it's a:b %é")
    load.add(31, "c", None)
    assert load.run() == changes.ChangedResult(3, 5, 4, 1)
    assert load.run() == changes.ChangedResult(0, 0, 0, 0)
    load.add(0, "d")
    load.add(400, "e")
    assert load.run() == changes.ChangedResult(2, 2, 2, 0)
    assert load.found() == ["c", "d", "e", "k"]


def test_a_file_that_is_added_or_touched(load, spark):
    load.add(0, "a")
    load.run()
    folder = f"{load.lake}/category=kitchen/year=2024/month=01/day=01"
    listings(spark, [listing(asin="b")]).drop("category").write.mode("append").parquet(folder)
    assert load.run().rows_read == 2
    # The same number and sizes, but another file.
    name = next(n for n in os.listdir(folder) if n.endswith(".parquet"))
    os.rename(f"{folder}/{name}", f"{folder}/x-{name}")
    assert load.run().category_days == 1
    assert load.found() == ["a", "b"]


def test_files_of_any_date_are_loaded(load):
    load.add(0, "a")
    load.run()
    load.add(1, "b")
    for folder, _, files in os.walk(load.lake):
        for name in files:
            if "day=02" in folder:
                os.utime(os.path.join(folder, name), (1_000_000_000, 1_000_000_000))
    load.run()
    assert load.found() == ["a", "b"]


def test_steps_of_bounded_size(load, monkeypatch):
    for day in range(5):
        load.add(day, f"a{day}")
    sizes = []
    record = changes.record_lines
    monkeypatch.setattr(changes, "record_lines", lambda s, r, m, lines: (sizes.append(len(lines)), record(s, r, m, lines)))
    assert load.run(at_once=2).category_days == 5
    assert sizes == [2, 2, 1]
    assert len(load.found()) == 5


def test_a_run_that_stops_before_its_line_is_written(load, monkeypatch):
    load.add(0, "a")
    load.add(1, "b")
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(changes, "record_lines", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        load.run(at_once=1)
    assert load.found() == ["a"]
    assert load.run().category_days == 2
    assert load.found() == ["a", "b"]


def test_a_lost_ledger_loads_again_and_adds_nothing(load, spark):
    load.add(0, "a")
    load.run()
    remove_folder(spark, load.ledger)
    assert load.run().category_days == 1
    assert load.found() == ["a"]


@pytest.mark.parametrize("remove", [False, True])
def test_vanished_category_days(load, spark, remove):
    load.add(0, "a", None)
    load.add(1, "b")
    load.add(60, "c")
    load.run()
    remove_folder(spark, f"{load.lake}/category=kitchen/year=2024/month=01/day=01")
    remove_folder(spark, f"{load.lake}/category=kitchen/year=2024/month=03")
    assert load.run(remove_vanished=remove).category_days == (2 if remove else 0)
    assert load.found() == (["b"] if remove else ["a", "b", "c"])
    if remove:
        assert spark.read.schema("asin string").parquet(load.warehouse.rejects).count() == 0
    assert load.run(remove_vanished=remove).category_days == 0
    load.add(0, "a")
    load.run(remove_vanished=remove)
    assert "a" in load.found()


def test_earlier_months_are_not_listed(load, spark):
    load.add(0, "a")
    load.add(31, "b")
    load.run(since=date(2024, 2, 1))
    assert load.found() == ["b"]
    assert list(months(spark, load.lake, load.ledger)) == [("2024", "01"), ("2024", "02")]
    load.run()
    assert load.found() == ["a", "b"]


def test_no_lake(load):
    assert load.run() == changes.ChangedResult(0, 0, 0, 0)


def test_the_ledger_holds_a_line_for_each_category_day(load, spark):
    for _ in range(4):
        load.add(0, "a", "b")
        load.run()
    month = f"{load.ledger}/month=202401"
    # The generation in use and the one before.
    assert len(names_in(spark, month)) == 2
    lines = spark.read.parquet(newest_generation(spark, month)).collect()
    assert [(r.category, r.day, r.files) for r in lines] == [("kitchen", "01", 1)]


def test_the_listing_opens_no_file(load, spark):
    load.add(0, "a")
    folder = f"{load.lake}/category=kitchen/year=2024/month=01/day=01"
    with open(f"{folder}/part-broken.parquet", "w") as file:
        file.write("no parquet")
    assert listed_month(spark, load.lake, ("2024", "01")).first()["files"] == 2


def test_category_days_by_name(spark, tmp_path):
    names = ["a b", "x:y", "50%", "q=1", "it's", 'a"b', "c[d]{e}", "é^~|<>", "", "t*?"]
    root = str(tmp_path / "lake")
    for n, name in enumerate(names):
        write_partitioned(listings(spark, [listing(rank=n)], name), root)
    keys = [(name or "__HIVE_DEFAULT_PARTITION__", "2024", "01", "01") for name in names]
    rows = read_category_days(spark, root, keys).collect()
    assert sorted((r.rank, r.category or "") for r in rows) == list(enumerate(names))


def test_names_are_escaped_as_spark_does(spark):
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    every = "".join(map(chr, range(1, 0x250)))
    assert escaped(every) == escape(every)


def test_generations(spark, tmp_path):
    root = str(tmp_path / "g")

    def write(n):
        return lambda folder: spark.range(n).write.parquet(folder)

    assert newest_generation(spark, root) is None
    for n in (1, 2, 3):
        write_generation(spark, root, write(n), note=f"-{n}")
    assert sorted(names_in(spark, root)) == ["g00000002-2", "g00000003-3"]
    with pytest.raises(RuntimeError):
        write_generation(spark, root, lambda folder: (write(9)(folder), (_ for _ in ()).throw(RuntimeError()))[1])
    # The mark is missing, so the one before is in use.
    assert newest_generation(spark, root) == f"{root}/g00000003-3"
    write_generation(spark, root, write(5))
    assert spark.read.parquet(newest_generation(spark, root)).count() == 5
    assert sorted(names_in(spark, root)) == ["g00000003-3", "g00000005"]


def test_written_category_days_become_partitions(spark, tmp_path, monkeypatch):
    """All of them, in few statements, and nothing is listed."""
    from shelflake.sources import lake as source

    root, table = str(tmp_path / "lake"), f"t_{uuid.uuid4().hex}"
    write_partitioned(listings(spark, [listing(rank=1)], "before"), root)
    monkeypatch.setattr(source, "refresh_lake", lambda *a: pytest.fail("the lake was listed"))
    register_lake(spark, table, root, find=False)
    assert spark.table(table).isEmpty()
    rows = [listing(rank=n, fetch_timestamp=NOON + timedelta(days=n)) for n in range(130)]
    frame = listings(spark, rows, "it's a:b").unionByName(listings(spark, rows[:1], "").unionByName(listings(spark, rows[:1])))
    statements = []
    sql = spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (statements.append(text), sql(text, *a, **k))[1])
    write_partitioned(frame, root, table=table)
    assert len(statements) == 2 and all(s.startswith("ALTER TABLE") for s in statements)
    assert spark.table(table).count() == 132
    assert len(spark.table(table).select("category", "year", "month", "day").distinct().collect()) == 132
    # Written again, it is there once.
    write_partitioned(frame.where("rank < 3"), root, table=table)
    assert spark.table(table).count() == 132
