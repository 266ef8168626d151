"""Corpus queries that SQL can express, against their SQL."""

from __future__ import annotations

import duckdb
import pytest
from compare import oracle_rows, spark_rows
from conftest import SF_DIR

from shelflake.llm.queries import ORACLES, QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


TABLES = ("documents", "pages", "benchmark", "conversations")


def oracle(sql):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection.sql(sql)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    relation = oracle(ORACLES[name])
    types = {f.name: TYPES[f.dataType.simpleString()] for f in result.schema}
    assert types == dict(zip(relation.columns, map(str, relation.types)))
    found = spark_rows(result)
    assert found
    assert found == oracle_rows(relation)
