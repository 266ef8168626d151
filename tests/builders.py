"""Small hand-made listings for the tests."""

from __future__ import annotations

from datetime import datetime

from shelflake.schema import LAKE_SCHEMA

NOON = datetime(2024, 1, 1, 12, 0)


def listing(**changes) -> dict:
    row = {
        "rank": 1,
        "asin": "B000000001",
        "product_title": "Title",
        "product_price": "$1.00",
        "product_star_rating": 4.5,
        "product_num_ratings": 10,
        "product_url": "https://example.com/dp/1",
        "product_photo": "https://example.com/img/1.jpg",
        "rank_change_label": None,
        "fetch_timestamp": NOON,
    }
    return row | changes


def listings(spark, rows, category="kitchen"):
    from pyspark.sql import types as T

    schema = T.StructType(LAKE_SCHEMA.fields + [T.StructField("category", T.StringType())])
    full = [{"category": category} | row for row in rows]
    return spark.createDataFrame([tuple(row[name] for name in schema.names) for row in full], schema)


def write_file(path, rows, row_group_size=None) -> None:
    """One single Parquet file, as other tools drop them."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
    schema = pa.schema(
        [
            (field.name, kinds.get(field.dataType.simpleString(), pa.timestamp("us")))
            for field in LAKE_SCHEMA
        ]
    )
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.Table.from_pylist(rows, schema=schema), path, row_group_size=row_group_size)
