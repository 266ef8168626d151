"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame


def _sorted_rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def spark_rows(result: DataFrame) -> list[tuple]:
    """Rows with their columns in name order. Times are read in the process's zone (UTC)."""
    return _sorted_rows(result.columns, [tuple(row) for row in result.collect()])


def oracle(sf_dir: str, sql: str) -> duckdb.DuckDBPyRelation:
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW part AS SELECT * FROM '{sf_dir}/part.parquet'")
    return connection.sql(sql)


def oracle_rows(relation: duckdb.DuckDBPyRelation) -> list[tuple]:
    return _sorted_rows(relation.columns, relation.fetchall())
