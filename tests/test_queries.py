"""Every registered query against its oracle, over the whole smallest data set."""

from __future__ import annotations

import __spark_entry__ as contract
import pytest
from compare import oracle, oracle_rows, spark_rows
from conftest import SF_DIR

from shelflake.catalogue import QUERIES
from shelflake.oracles import ORACLES

DUCKDB_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "decimal(10,2)": "DECIMAL(10,2)",
}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    result = contract.queries()[name](spark, SF_DIR)
    relation = oracle(SF_DIR, contract.oracle_sql()[name])
    types = {f.name: DUCKDB_TYPES[f.dataType.simpleString()] for f in result.schema}
    assert types == dict(zip(relation.columns, map(str, relation.types)))
    found = spark_rows(result)
    assert found
    assert found == oracle_rows(relation)


def test_entry(spark):
    assert contract.entry(spark).count() == 200
