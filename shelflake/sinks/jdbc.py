"""The warehouse table in a database reached through JDBC.

Each Spark task commits its own rows, and a task that is repeated after a lost executor
would insert them again. So rows go to a staging table first, with the stored file and
position they come from; the target is then filled inside the database, in one
transaction, from one staged row for each place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.surrogate import file_number
from ..schema import IDENTITY_COLUMN, WAREHOUSE_LIMITS, WAREHOUSE_REQUIRED, WAREHOUSE_SCHEMA

ORIGIN_COLUMNS = ("stage_file", "stage_row")

_SQL_TYPES = {"int": "INT", "double": "DOUBLE PRECISION", "timestamp": "TIMESTAMP"}


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f'"{name}"' for name in names)


def table_ddl(table: str, *, identity: str = "GENERATED BY DEFAULT AS IDENTITY") -> str:
    """``CREATE TABLE`` for the target, to be run once in the database.

    ``identity`` is the database's own way to write an identity column.
    """
    lines = [f'"{IDENTITY_COLUMN}" BIGINT {identity} NOT NULL PRIMARY KEY']
    for field in WAREHOUSE_SCHEMA:
        limit = WAREHOUSE_LIMITS.get(field.name)
        plain = field.dataType.simpleString()
        kind = f"VARCHAR({limit})" if limit else _SQL_TYPES.get(plain, plain.upper())
        required = " NOT NULL" if field.name in WAREHOUSE_REQUIRED else ""
        lines.append(f'"{field.name}" {kind}{required}')
    return f"CREATE TABLE {table} ({', '.join(lines)})"


def with_origin(stored: DataFrame) -> DataFrame:
    """Add where each row of a Parquet dataset of one write stands; unique and repeatable."""
    return stored.select(
        *WAREHOUSE_SCHEMA.names,
        file_number().alias(ORIGIN_COLUMNS[0]),
        F.col("_metadata.row_index").alias(ORIGIN_COLUMNS[1]),
    )


def jdbc_options(
    url: str, table: str, *, connections: int, batch_rows: int = 10_000, **extra: str
) -> dict[str, str]:
    """Writer options: rows per round trip, and a limit on open connections.

    Text lengths are named for the table Spark creates; a database's own default for
    text may be too short.
    """
    return {
        "url": url,
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": str(batch_rows),
        "createTableColumnTypes": ", ".join(f"{n} VARCHAR({size})" for n, size in WAREHOUSE_LIMITS.items()),
        **extra,
    }


def stage_rows(stored: DataFrame, options: dict[str, str]) -> None:
    """Fill the staging table, replacing what an earlier attempt left there."""
    with_origin(stored).write.format("jdbc").options(**options).mode("overwrite").save()


def publish_statements(
    table: str,
    staging: str | None,
    *,
    replace_day: date | None = None,
    categories: Sequence[str] | None = None,
) -> list[str]:
    """Statements of the one transaction that fills the target.

    ``replace_day`` first removes that day's rows, or those of ``categories``; without it the rows
    are appended. Without a staging table nothing is added. The database hands out the keys.
    """
    columns = _quoted(WAREHOUSE_SCHEMA.names)
    origin = _quoted(ORIGIN_COLUMNS)
    statements = []
    if replace_day is not None:
        start, end = (f"TIMESTAMP '{d} 00:00:00'" for d in (replace_day, replace_day + timedelta(1)))
        named = ""
        if categories is not None:
            values = ", ".join("'" + c.replace("'", "''") + "'" for c in categories)
            named = f' AND "category" IN ({values})'
        statements.append(
            f'DELETE FROM {table} WHERE "fetch_timestamp" >= {start} AND "fetch_timestamp" < {end}{named}'
        )
    if staging is None:
        return statements
    statements.append(
        f"INSERT INTO {table} ({columns}) "
        f"SELECT {columns} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {origin} ORDER BY {origin}) "
        f"AS nth FROM {staging}) AS staged WHERE nth = 1"
    )
    return statements


def load_through_staging(
    stored: DataFrame | None,
    table: str,
    options: dict[str, str],
    run_transaction: Callable[[list[str]], None],
    *,
    replace_day: date | None = None,
    categories: Sequence[str] | None = None,
) -> None:
    """Stage the rows with Spark, if there are any, then publish them in the database.

    ``options`` address the staging table. ``run_transaction`` runs statements in one
    transaction, on whatever connection the caller's database client offers.
    """
    staging = None
    if stored is not None:
        stage_rows(stored, options)
        staging = options["dbtable"]
    statements = publish_statements(table, staging, replace_day=replace_day, categories=categories)
    if statements:
        run_transaction(statements)
