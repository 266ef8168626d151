"""One lake day -> warehouse table."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import business_day, day_key
from ..operators import (
    LOSSES,
    loss_counts,
    lost_values,
    warehouse_losses,
    warehouse_rows,
    with_identity,
    with_violations,
)
from ..operators.constraints import VIOLATIONS
from ..operators.losses import LOSS_COLUMNS
from ..schema import IDENTITY_COLUMN, OFFSET_HOURS, SNAPSHOT_DAY, WAREHOUSE_SCHEMA
from ..session import passing_path
from ..sinks.jdbc import load_through_staging
from ..sinks.warehouse import (
    CategoryDay,
    Warehouse,
    category_name,
    create_table,
    drop_rejects,
    insert_rows,
    publish_version,
    rejected_categories,
    reserve_ids,
    stored_category_days,
    write_rejects,
)
from ..sources import read_day
from ..sources.lake import categories_of_day

_MODES = ("append", "replace_day")


def _check_mode(mode: str) -> None:
    if mode not in _MODES:
        raise ValueError(f"unknown mode {mode!r}; known are {', '.join(_MODES)}")


@dataclass(frozen=True)
class LoadResult:
    day: date
    rows_read: int
    rows_loaded: int
    rows_rejected: int
    #: Values that were there and do not fit their column's type, by column.
    lost: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Staged:
    """Listings in warehouse form, stored, with accepted and rejected rows apart."""

    root: str
    rows_read: int
    rows_rejected: int
    lost: dict[str, int]

    @property
    def rows_accepted(self) -> int:
        return self.rows_read - self.rows_rejected

    def result(self, day: date) -> LoadResult:
        return LoadResult(day, self.rows_read, self.rows_accepted, self.rows_rejected, self.lost)

    def accepted(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_STAGED_SCHEMA).parquet(f"{self.root}/accepted=true")

    def rejected(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType(_STAGED_SCHEMA.fields + [T.StructField(VIOLATIONS, T.StringType())])
        return spark.read.schema(schema).parquet(f"{self.root}/accepted=false")

    def losses(self, spark: SparkSession) -> DataFrame:
        """The number of lost values of each category-day and column."""
        kept = T.StructType().add(SNAPSHOT_DAY, "string").add("category", "string").add(LOSSES, "integer")
        return lost_values(spark.read.schema(kept).parquet(self.root), SNAPSHOT_DAY, "category")

    def category_days(self, spark: SparkSession, accepted: bool) -> set[CategoryDay]:
        """(day, category) of the accepted or of the rejected rows; as few as the lake has folders."""
        if not (self.rows_accepted if accepted else self.rows_rejected):
            return set()
        rows = self.accepted(spark) if accepted else self.rejected(spark)
        found = rows.select(SNAPSHOT_DAY, "category").distinct().collect()
        return {(r[SNAPSHOT_DAY], category_name(r["category"])) for r in found}


_DAY_KEYS = ("year", "month", "day")
_STAGED_SCHEMA = T.StructType([*WAREHOUSE_SCHEMA.fields, T.StructField(SNAPSHOT_DAY, T.StringType())])


def stage(listings: DataFrame, path: str) -> Staged:
    """Transform and check the listings and store them, in one pass over the input.

    The counts are taken during that pass. It has no shuffle, so each row is counted
    exactly once even if tasks are repeated. A row's snapshot day is the lake day it lies in, or
    that of its fetch time where the listings come from elsewhere.
    """
    counts = Observation()
    in_lake = set(_DAY_KEYS) <= set(listings.columns)
    day = F.concat(*_DAY_KEYS) if in_lake else day_key(F.col("fetch_timestamp"))
    rows = warehouse_rows(listings, day.alias(SNAPSHOT_DAY), warehouse_losses().alias(LOSSES))
    checked = with_violations(rows).observe(
        counts,
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col(VIOLATIONS) != "").alias("rows_rejected"),
        *loss_counts(),
    )
    (
        checked.withColumn("accepted", F.col(VIOLATIONS) == "")
        .write.partitionBy("accepted")
        .parquet(path)
    )
    found = dict(counts.get)
    lost = {name: found[f"lost_{name}"] for name in LOSS_COLUMNS if found[f"lost_{name}"]}
    return Staged(path, found["rows_read"], found["rows_rejected"], lost)


@contextmanager
def _staged_day(
    spark: SparkSession, lake_root: str, day: date, categories: Sequence[str] | None
) -> Iterator[Staged]:
    with passing_path(spark, "load") as path:
        yield stage(read_day(spark, lake_root, day=day, categories=categories), path)


def append(spark: SparkSession, staged: Staged, warehouse: Warehouse) -> None:
    """Add staged rows to the table, and the rejected ones beside it.

    Category-days that the table does not have appear all at once; to the others the rows are added where
    those lie.
    """
    if staged.rows_accepted:
        after = reserve_ids(spark, warehouse, staged.rows_accepted)
        rows = with_identity(staged.accepted(spark), IDENTITY_COLUMN, after=after)
        brought = staged.category_days(spark, accepted=True)
        stored = {key for day in {d for d, _ in brought} for key in stored_category_days(spark, warehouse, day)}
        new = brought - stored
        if new:
            publish_version(spark, warehouse, after + 1, rows.where(_is_one_of(new)) if brought & stored else rows, new)
        if brought & stored:
            insert_rows(rows.where(~_is_one_of(new)) if new else rows, warehouse)
    if staged.rows_rejected:
        write_rejects(staged.rejected(spark), warehouse.rejects, replace=False)


def _is_one_of(keys: Collection[CategoryDay]) -> Column:
    """Whether a row belongs to one of some category-days. They are as few as the lake has folders."""
    category = F.when(F.coalesce("category", F.lit("")) == "", category_name(None)).otherwise(F.col("category"))
    return F.concat_ws("/", SNAPSHOT_DAY, category).isin(*(f"{d}/{c}" for d, c in keys))


def replace(spark: SparkSession, staged: Staged, warehouse: Warehouse, scope: Collection[CategoryDay]) -> None:
    """Put staged rows in the place of the category-days of ``scope``, and the rejected ones beside it.

    Category-days of the scope without an accepted row are emptied. The table changes in one step; the
    rejects follow it, and a run that stopped between is made good by running it again.
    """
    scope = set(scope) | staged.category_days(spark, accepted=True)
    if scope:
        # A load without rows takes one key, so that its version has a number of its own.
        after = reserve_ids(spark, warehouse, max(1, staged.rows_accepted))
        rows = None
        if staged.rows_accepted:
            rows = with_identity(staged.accepted(spark), IDENTITY_COLUMN, after=after)
        publish_version(spark, warehouse, after + 1, rows, scope)
    _replace_rejects(spark, staged, warehouse.rejects, scope)


def _replace_rejects(spark: SparkSession, staged: Staged, root: str, scope: Collection[CategoryDay]) -> None:
    rejected = staged.category_days(spark, accepted=False)
    if rejected:
        write_rejects(staged.rejected(spark), root, replace=True)
    for day in {d for d, _ in scope}:
        drop_rejects(spark, root, day, lambda c: (day, c) in scope and (day, c) not in rejected)


def _scope(
    spark: SparkSession,
    lake_root: str,
    day: date,
    categories: Sequence[str] | None,
    stored: Iterable[CategoryDay],
    rejects_root: str,
) -> set[CategoryDay]:
    """The category-days that a load of a day replaces.

    They come from the lake's folders, with or without rows; a load of the whole day also replaces all that
    is stored of it.
    """
    key = f"{day:%Y%m%d}"
    here = {(key, category_name(c)) for c in categories_of_day(spark, lake_root, day)}
    if categories is not None:
        return here & {(key, category_name(c)) for c in categories}
    return here | set(stored) | {(key, c) for c in rejected_categories(spark, rejects_root, key)}


def load_day(
    spark: SparkSession,
    lake_root: str,
    warehouse: Warehouse,
    *,
    day: date | None = None,
    as_of: datetime | None = None,
    offset_hours: int = OFFSET_HOURS,
    categories: Sequence[str] | None = None,
    mode: str = "append",
) -> LoadResult:
    """Load one day. A missing or empty day loads nothing and is not an error.

    ``append`` stores a repeated load twice; ``replace_day`` makes it idempotent: it replaces
    the day, which is then empty if the lake has nothing of it, or with ``categories`` what the lake has
    folders of, also where no row is accepted. Readers see the day before or the day after. Rows
    that break a table constraint go to the warehouse's rejects instead. Two loads of one day must not run
    at once.
    """
    _check_mode(mode)
    day = day or business_day(as_of, offset_hours)
    create_table(spark, warehouse)
    with _staged_day(spark, lake_root, day, categories) as staged:
        if mode == "append":
            append(spark, staged, warehouse)
        else:
            stored = stored_category_days(spark, warehouse, f"{day:%Y%m%d}")
            scope = _scope(spark, lake_root, day, categories, stored, warehouse.rejects)
            replace(spark, staged, warehouse, scope)
        return staged.result(day)


def load_day_to_database(
    spark: SparkSession,
    lake_root: str,
    table: str,
    staging_options: dict[str, str],
    run_transaction: Callable[[list[str]], None],
    *,
    rejects_root: str,
    day: date | None = None,
    as_of: datetime | None = None,
    offset_hours: int = OFFSET_HOURS,
    categories: Sequence[str] | None = None,
    mode: str = "append",
) -> LoadResult:
    """The same load into a database table, which hands out the keys itself.

    See :mod:`shelflake.sinks.jdbc` for the staging options and the transaction.
    """
    _check_mode(mode)
    day = day or business_day(as_of, offset_hours)
    with _staged_day(spark, lake_root, day, categories) as staged:
        replaces = mode == "replace_day"
        scope = _scope(spark, lake_root, day, categories, (), rejects_root) if replaces else set()
        named = None if categories is None else sorted({c for _, c in scope})
        if staged.rows_read or (replaces and named != []):
            load_through_staging(
                staged.accepted(spark) if staged.rows_accepted else None,
                table,
                staging_options,
                run_transaction,
                replace_day=day if replaces else None,
                categories=named,
            )
        if replaces:
            _replace_rejects(spark, staged, rejects_root, scope)
        elif staged.rows_rejected:
            write_rejects(staged.rejected(spark), rejects_root, replace=False)
        return staged.result(day)
