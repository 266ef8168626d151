"""The warehouse table in the catalog.

A load writes the category-days it brings to a folder of its own, its version, and then points the
table's partitions there, all in one call to the catalog. Until that call readers see what was there
before, after it what is there now. Folders that are no longer pointed at are removed last.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import (
    make_folder,
    mark,
    matches,
    names_in,
    path_exists,
    remove_folder,
    remove_if_bare,
    renamed,
)
from ..partitions import (
    NO_VALUE,
    add_partitions,
    drop_partitions,
    escaped,
    literal,
    partition_folders,
    point_partitions,
)
from ..schema import IDENTITY_COLUMN, SNAPSHOT_DAY, WAREHOUSE_LIMITS, WAREHOUSE_SCHEMA


@dataclass(frozen=True)
class Warehouse:
    """A table name and the folder that holds its rows, its keys and its rejects."""

    table: str
    root: str

    @property
    def rows(self) -> str:
        """The table's own place, where loads of earlier releases have put their rows."""
        return f"{self.root}/rows"

    @property
    def versions(self) -> str:
        """A folder for each load."""
        return f"{self.root}/versions"

    @property
    def reserved(self) -> str:
        return f"{self.root}/key_range"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"


#: The table's partitioning: a load replaces category-days.
KEYS = (SNAPSHOT_DAY, "category")

#: Snapshot day and category, the latter as its folder is named.
CategoryDay = tuple[str, str]

TABLE_COLUMNS = (
    IDENTITY_COLUMN,
    *(name for name in WAREHOUSE_SCHEMA.names if name not in KEYS),
    *KEYS,
)


def _catalog_type(field: T.StructField) -> str:
    limit = WAREHOUSE_LIMITS.get(field.name)
    return f"VARCHAR({limit})" if limit else field.dataType.simpleString()


def create_table(spark: SparkSession, warehouse: Warehouse) -> None:
    """The thirteen warehouse columns, partitioned by snapshot day and category, unless it exists.

    Text lengths are enforced on insert. The catalog keeps no key counter and enforces
    no NOT NULL on Parquet tables: see :func:`reserve_ids` and the constraint operator.
    An overwrite replaces the category-days that it brings; the table itself says so, not the session.
    """
    if spark.catalog.tableExists(warehouse.table):
        return
    types = {f.name: _catalog_type(f) for f in WAREHOUSE_SCHEMA}
    types |= {IDENTITY_COLUMN: "BIGINT", SNAPSHOT_DAY: "STRING"}
    columns = ", ".join(f"`{name}` {types[name]}" for name in TABLE_COLUMNS)
    spark.sql(
        f"CREATE TABLE {warehouse.table} ({columns}) USING parquet "
        f"OPTIONS ('partitionOverwriteMode' 'dynamic') "
        f"PARTITIONED BY ({', '.join(KEYS)}) LOCATION {literal(warehouse.rows)}"
    )
    if path_exists(spark, warehouse.rows):
        # The rows are older than this catalog entry.
        spark.sql(f"MSCK REPAIR TABLE {warehouse.table}")
    if path_exists(spark, warehouse.versions):
        _find_versions(spark, warehouse)


# --- keys --------------------------------------------------------------------


def reserve_ids(spark: SparkSession, warehouse: Warehouse, count: int) -> int:
    """Set ``count`` keys aside for a load and return the last key before them.

    One file tells the newest range by its name, ``first-last``. A claim renames it to the range
    behind, and of two loads at once one finds it still there; the other looks again. So a claim is
    made in one step or not at all, and there is one name to be listed however many loads there were.
    Like a database sequence this leaves a gap if the load then fails. Where the file is lost, the table
    itself tells the highest key.
    """
    for _ in range(_ATTEMPTS):
        ranges = [name for name in names_in(spark, warehouse.reserved) if _last_of(name) is not None]
        if not ranges:
            if not path_exists(spark, warehouse.reserved):
                _start_keys(spark, warehouse)
            else:  # just being renamed
                time.sleep(0.05)
            continue
        newest = max(ranges, key=_last_of)
        last = _last_of(newest)
        claimed = f"{last + 1}-{last + count}"
        if renamed(spark, f"{warehouse.reserved}/{newest}", f"{warehouse.reserved}/{claimed}"):
            return last
    raise RuntimeError(f"no key range could be claimed in {warehouse.reserved}")


_ATTEMPTS = 200


def _last_of(name: str) -> int | None:
    first, dash, last = name.partition("-")
    return int(last) if dash and first.isdigit() and last.isdigit() else None


def _start_keys(spark: SparkSession, warehouse: Warehouse) -> None:
    """Begin behind the table's highest key. The folder and the name in it appear in one step."""
    last = spark.table(warehouse.table).agg(F.max(IDENTITY_COLUMN)).first()[0] or 0
    fresh = f"{warehouse.reserved}-{uuid.uuid4().hex}"
    mark(spark, f"{fresh}/0-{last}")
    renamed(spark, fresh, warehouse.reserved)
    # Where another load was first, this one's folder is left over, or was put into the other.
    remove_folder(spark, fresh)
    remove_folder(spark, f"{warehouse.reserved}/{fresh.rsplit('/', 1)[-1]}")


# --- rows --------------------------------------------------------------------


def category_name(category: str | None) -> str:
    """A category as its folder is named."""
    return NO_VALUE if category is None or category == "" else category


def stored_category_days(spark: SparkSession, warehouse: Warehouse, day: str) -> dict[CategoryDay, str]:
    """The folder of each of a day's categories in the table."""
    return partition_folders(spark, warehouse.table, KEYS, {SNAPSHOT_DAY: day})


def insert_rows(rows: DataFrame, warehouse: Warehouse) -> None:
    """Append to category-days, where they lie. There is no key check: loading a day twice stores it twice."""
    rows.select(*TABLE_COLUMNS).write.insertInto(warehouse.table)


def publish_version(
    spark: SparkSession,
    warehouse: Warehouse,
    version: int,
    rows: DataFrame | None,
    scope: Collection[CategoryDay],
) -> None:
    """Replace the category-days of ``scope``, which hold all of ``rows``, in one step.

    Those without a row are emptied. ``version`` is larger than that of any load before. A run that stops
    has left everything as it was or everything as it should be; folders that it left over are
    removed by :func:`remove_left_over`.
    """
    folder = f"{warehouse.versions}/{version:020d}"
    if rows is not None:
        rows.select(*TABLE_COLUMNS).write.mode("overwrite").partitionBy(*KEYS).parquet(folder)
    folders = _complete(spark, folder, scope)
    before = {
        key: place
        for day in {d for d, _ in scope}
        for key, place in stored_category_days(spark, warehouse, day).items()
        if key in scope
    }
    _announce(spark, warehouse, [key for key in folders if key not in before])
    point_partitions(spark, warehouse.table, KEYS, folders)
    _forget(spark, warehouse, folders)
    _retire(spark, before.values())


_PUBLISHED = "_published"


def _folders_of(spark: SparkSession, version: str) -> dict[CategoryDay, str]:
    """The category-days of a version, by their folders."""
    found = matches(spark, f"{version}/{SNAPSHOT_DAY}=*/category=*")
    keys = {}
    for place in found:
        day, category = place.rsplit("/", 2)[1:]
        keys[unquote(day.partition("=")[2]), unquote(category.partition("=")[2])] = place
    return keys


def _complete(spark: SparkSession, folder: str, scope: Collection[CategoryDay]) -> dict[CategoryDay, str]:
    """Give every category-day of the scope a folder, if an empty one, and call the version whole."""
    there = _folders_of(spark, folder)
    for day, category in scope:
        if (day, category) not in there:
            make_folder(spark, f"{folder}/{SNAPSHOT_DAY}={day}/category={escaped(category)}")
    mark(spark, f"{folder}/{_PUBLISHED}")
    return _folders_of(spark, folder)


def _announce(spark: SparkSession, warehouse: Warehouse, keys: Collection[CategoryDay]) -> None:
    """Partitions for category-days that the table does not have yet, without a row so far."""
    empty = f"{warehouse.versions}/_none"
    if keys:
        make_folder(spark, empty)
        add_partitions(spark, warehouse.table, KEYS, keys, empty)


def _forget(spark: SparkSession, warehouse: Warehouse, folders: Mapping[CategoryDay, str]) -> None:
    """Drop the partitions of category-days that were emptied. Their folders stay, to tell a new catalog so."""
    empty = [key for key, place in folders.items() if not names_in(spark, place)]
    drop_partitions(spark, warehouse.table, KEYS, empty)
    spark.catalog.refreshTable(warehouse.table)


def _retire(spark: SparkSession, places: Collection[str]) -> None:
    """Remove folders that the table no longer points at, and versions of which nothing is left."""
    for place in places:
        remove_folder(spark, place)
        day = place.rsplit("/", 1)[0]
        if remove_if_bare(spark, day):
            remove_if_bare(spark, day.rsplit("/", 1)[0])


def _find_versions(spark: SparkSession, warehouse: Warehouse) -> None:
    """Point a new catalog's table at the newest whole version of each category-day."""
    newest: dict[CategoryDay, str] = {}
    for version in sorted(name for name in names_in(spark, warehouse.versions) if name.isdigit()):
        if path_exists(spark, f"{warehouse.versions}/{version}/{_PUBLISHED}"):
            newest |= _folders_of(spark, f"{warehouse.versions}/{version}")
    if newest:
        _announce(spark, warehouse, newest)
        point_partitions(spark, warehouse.table, KEYS, newest)
        _forget(spark, warehouse, newest)


def remove_left_over(spark: SparkSession, warehouse: Warehouse) -> int:
    """Remove the folders that stopped loads have left, those the table points at excepted.

    Lists the versions. Not while a load is at work on the table. Rows go first and then the empty folders
    that stand for emptied category-days, which have nothing left to stand against. Returns the number of
    folders with rows.
    """
    pointed = set(partition_folders(spark, warehouse.table, KEYS).values())
    versions = [f"{warehouse.versions}/{n}" for n in names_in(spark, warehouse.versions) if n.isdigit()]
    left = {place: key for v in versions for key, place in _folders_of(spark, v).items() if place not in pointed}
    filled = [place for place in left if names_in(spark, place)]
    emptied = {key for place, key in left.items() if place not in filled}
    early = _folders_of(spark, warehouse.rows)
    filled += [place for key, place in early.items() if key in emptied and place not in pointed]
    _retire(spark, filled)
    _retire(spark, set(left) - set(filled))
    for version in versions:
        remove_if_bare(spark, version)
    return len(filled)


# --- rejects -----------------------------------------------------------------


def rejected_categories(spark: SparkSession, root: str, day: str) -> dict[str, str]:
    """Folder names of a day's rejects, by category. They are few: folders, not rows."""
    names = names_in(spark, f"{root}/{SNAPSHOT_DAY}={day}")
    return {unquote(n.removeprefix("category=")): n for n in names if n.startswith("category=")}


def drop_rejects(spark: SparkSession, root: str, day: str, drop: Callable[[str], bool]) -> None:
    for category, folder in rejected_categories(spark, root, day).items():
        if drop(category):
            remove_folder(spark, f"{root}/{SNAPSHOT_DAY}={day}/{folder}")


def write_rejects(rows: DataFrame, root: str, *, replace: bool) -> None:
    """``snapshot_day=/category=``; replacing overwrites the category-days that occur."""
    writer = rows.write.mode("overwrite" if replace else "append").partitionBy(*KEYS)
    writer.option("partitionOverwriteMode", "dynamic").parquet(root)
