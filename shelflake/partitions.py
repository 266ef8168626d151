"""The partitions of a catalog table and where they lie.

Spark's SQL points one partition at a time. The catalog itself takes a list, and an external one
takes it as one transaction, so that is what is used where several must change together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

from pyspark.sql import SparkSession

#: Values of the partition columns, in the table's order.
Key = tuple[str, ...]

#: Partitions named in one statement.
BATCH = 100

#: How Spark names the folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

# Characters that are escaped in folder names, beside control characters: fixed values of the format.
_ESCAPED = set("\"#%'*/:=?\\\x7f{[]^")


def escaped(value: str) -> str:
    """A partition value as its folder is named."""
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED or c < " " else c for c in value)


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(columns: Sequence[str], key: Key) -> str:
    return "PARTITION (" + ", ".join(f"`{c}`={literal(v)}" for c, v in zip(columns, key)) + ")"


def _batches(keys: Iterable[Key]) -> Iterator[list[Key]]:
    batch = []
    for key in keys:
        batch.append(key)
        if len(batch) == BATCH:
            yield batch
            batch = []
    if batch:
        yield batch


def add_partitions(
    spark: SparkSession,
    table: str,
    columns: Sequence[str],
    keys: Iterable[Key],
    location: str | None = None,
) -> None:
    """Add partitions that are not there yet, at their usual places or all at ``location``.

    A statement names so many of them at most. Nothing is listed.
    """
    place = "" if location is None else f" LOCATION {literal(location)}"
    for batch in _batches(keys):
        named = " ".join(_spec(columns, key) + place for key in batch)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {named}")


def drop_partitions(spark: SparkSession, table: str, columns: Sequence[str], keys: Iterable[Key]) -> None:
    """Forget partitions. The folders of an external table stay."""
    for batch in _batches(keys):
        named = ", ".join(_spec(columns, key) for key in batch)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {named}")


def _catalog(spark: SparkSession, table: str):
    state = spark._jsparkSession.sessionState()
    return state.catalog(), state.sqlParser().parseTableIdentifier(table)


def _found(spark: SparkSession, table: str, columns: Sequence[str], within: Mapping[str, str] | None):
    catalog, name = _catalog(spark, table)
    spec = spark._jvm.PythonUtils.toScalaMap(dict(within or {}))
    partitions = catalog.listPartitions(name, spark._jvm.scala.Option.apply(spec if within else None))
    for n in range(partitions.size()):
        partition = partitions.apply(n)
        yield tuple(partition.spec().apply(c) for c in columns), partition


def partition_folders(
    spark: SparkSession, table: str, columns: Sequence[str], within: Mapping[str, str] | None = None
) -> dict[Key, str]:
    """The folder of each partition, or of those that have the values in ``within``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return {
        key: path(partition.location()).toString()
        for key, partition in _found(spark, table, columns, within)
    }


def point_partitions(
    spark: SparkSession, table: str, columns: Sequence[str], folders: Mapping[Key, str]
) -> None:
    """Move partitions that are there to other folders, all in one call to the catalog."""
    catalog, name = _catalog(spark, table)
    jvm = spark._jvm
    moved = []
    for first in sorted({key[0] for key in folders}):
        for key, partition in _found(spark, table, columns, {columns[0]: first}):
            if key in folders:
                place = jvm.scala.Option.apply(jvm.org.apache.hadoop.fs.Path(folders[key]).toUri())
                old = partition.storage()
                storage = old.copy(place, *(getattr(old, n)() for n in _names(old)[1:]))
                others = (getattr(partition, n)() for n in _names(partition)[2:])
                moved.append(partition.copy(partition.spec(), storage, *others))
    if moved:
        catalog.alterPartitions(name, jvm.PythonUtils.toSeq(moved))
    spark.catalog.refreshTable(table)


def _names(row) -> list[str]:
    """The fields of a catalog entry, in order."""
    names = row.productElementNames()
    found = []
    while names.hasNext():
        found.append(names.next())
    return found
