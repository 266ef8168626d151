"""The database path. No database is started: statements and options are checked as text,
and the publishing statements run in the oracle engine."""

from __future__ import annotations

from datetime import date

import duckdb
from builders import listing, listings

from shelflake.operators import warehouse_rows
from shelflake.plans import load_day_to_database
from shelflake.sinks import jdbc, write_partitioned


def test_table_definition():
    ddl = jdbc.table_ddl("listings")
    assert ddl.startswith(
        'CREATE TABLE listings ("unique_id" BIGINT GENERATED BY DEFAULT AS IDENTITY NOT NULL PRIMARY KEY'
    )
    assert '"asin" VARCHAR(50) NOT NULL' in ddl
    assert '"product_price" DECIMAL(10,2)' in ddl
    assert '"product_star_rating" DOUBLE PRECISION' in ddl
    assert 'IDENTITY(1,1) NOT NULL' in jdbc.table_ddl("t", identity="IDENTITY(1,1)")


def test_options():
    options = jdbc.jdbc_options("jdbc:x:y", "stage", connections=4, driver="a.b.C")
    assert options == {
        "url": "jdbc:x:y", "dbtable": "stage", "numPartitions": "4", "batchsize": "10000",
        "driver": "a.b.C",
        "createTableColumnTypes": "category VARCHAR(255), product_photo VARCHAR(1000), "
        "product_url VARCHAR(1000), currency VARCHAR(10), short_product_title VARCHAR(500), "
        "product_title VARCHAR(1000), asin VARCHAR(50)",
    }


def staged(spark, tmp_path, *rows):
    path = str(tmp_path / "stored")
    warehouse_rows(listings(spark, rows)).write.mode("overwrite").parquet(path)
    return jdbc.with_origin(spark.read.parquet(path))


def test_origin_tells_equal_rows_apart(spark, tmp_path):
    frame = staged(spark, tmp_path, listing(), listing(), listing())
    assert frame.count() == 3
    assert frame.select(*jdbc.ORIGIN_COLUMNS).distinct().count() == 3


def test_publishing_ignores_rows_staged_twice(spark, tmp_path):
    """As after a task that was repeated because its executor was lost."""
    frame = staged(spark, tmp_path, listing(), listing(), listing(rank=2))
    repeated = frame.unionByName(frame.where("rank = 1")).toPandas()

    database = duckdb.connect()
    database.execute("CREATE SEQUENCE ids")
    database.execute(jdbc.table_ddl("listings", identity="DEFAULT nextval('ids')"))
    database.execute("CREATE TABLE stage AS SELECT * FROM repeated")

    def publish(day=None):
        for statement in jdbc.publish_statements("listings", "stage", replace_day=day):
            database.execute(statement)
        return database.sql('SELECT "rank" FROM listings ORDER BY 1').fetchall()

    assert publish() == [(1,), (1,), (2,)]
    assert len(publish()) == 6
    assert publish(date(2024, 1, 1)) == [(1,), (1,), (2,)]
    assert len(publish(date(2024, 1, 2))) == 6
    keys = database.sql("SELECT count(DISTINCT unique_id), count(*) FROM listings").fetchall()
    assert keys == [(6, 6)]
    assert len(repeated) > 3


def test_a_day_goes_through_the_staging_table(spark, tmp_path, monkeypatch):
    lake, rejects = str(tmp_path / "lake"), str(tmp_path / "rejects")
    rows = [listing(rank=1), listing(rank=2), listing(rank=3, asin=None)]
    write_partitioned(listings(spark, rows), lake)
    options = jdbc.jdbc_options("jdbc:x:y", "stage", connections=2)
    seen = []
    monkeypatch.setattr(
        jdbc,
        "stage_rows",
        lambda stored, given: seen.append((jdbc.with_origin(stored).collect(), given)),
    )

    def load(day, mode):
        return load_day_to_database(
            spark, lake, "listings", options, seen.append, rejects_root=rejects, day=day, mode=mode
        )

    result = load(date(2024, 1, 1), "replace_day")
    assert (result.rows_read, result.rows_loaded, result.rows_rejected) == (3, 2, 1)
    (stored, given), statements = seen
    assert sorted(row.rank for row in stored) == [1, 2]
    assert given is options
    assert statements == jdbc.publish_statements("listings", "stage", replace_day=date(2024, 1, 1))
    assert spark.read.parquet(rejects).count() == 1

    seen.clear()
    assert load(date(2030, 1, 1), "append").rows_read == 0
    assert seen == []


def test_statements_of_replaced_categories():
    day = date(2024, 1, 1)
    delete, insert = jdbc.publish_statements("t", "s", replace_day=day, categories=["a", "b's"])
    assert delete.endswith("""AND "category" IN ('a', 'b''s')""")
    assert insert.startswith("INSERT INTO t")
    # A day of rejected rows only is emptied.
    assert len(jdbc.publish_statements("t", None, replace_day=day)) == 1
    assert jdbc.publish_statements("t", None) == []
