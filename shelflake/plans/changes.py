"""What has changed in the lake -> warehouse table, by a ledger of category-days."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession

from ..session import passing_path
from ..sinks.warehouse import Warehouse, create_table
from ..sources.lake import read_category_days
from ..sources.ledger import changed_lines, listed_month, months, record_lines, recorded_month
from .load import replace, stage

#: Category-days that are staged together.
AT_ONCE = 1000


@dataclass(frozen=True)
class ChangedResult:
    category_days: int
    rows_read: int
    rows_loaded: int
    rows_rejected: int


def load_changed_days(
    spark: SparkSession,
    lake_root: str,
    warehouse: Warehouse,
    ledger_root: str,
    *,
    since: date | None = None,
    remove_vanished: bool = False,
    at_once: int = AT_ONCE,
) -> ChangedResult:
    """Load every category-day whose files are not those that were loaded last.

    The lake is listed a month at a time and held against the ledger's lines of that month; file names
    stay in the tasks. Files of any date count, so late ones are found; ``since`` leaves earlier months
    unlisted. Changed category-days are read whole and replaced in the table and its rejects, ``at_once``
    of them in one step, and are written into the ledger after that: a run that stops repeats a
    step and adds nothing. Files that change meanwhile are found by the next run. A category-day that
    vanished stays in the table, or is removed with ``remove_vanished``.
    """
    create_table(spark, warehouse)
    counts = [0, 0, 0, 0]
    for month in months(spark, lake_root, ledger_root, since):
        listed = listed_month(spark, lake_root, month)
        lines = changed_lines(listed, recorded_month(spark, ledger_root, month)).collect()
        lines = [line for line in lines if line["files"] or remove_vanished]
        lines.sort(key=lambda line: (line["day"], line["category"]))
        for start in range(0, len(lines), at_once):
            step = lines[start : start + at_once]
            with passing_path(spark, "load") as path:
                keys = [tuple(line)[:4] for line in step if line["files"]]
                staged = stage(read_category_days(spark, lake_root, keys), path)
                scope = {(line["year"] + line["month"] + line["day"], line["category"]) for line in step}
                replace(spark, staged, warehouse, scope)
            record_lines(spark, ledger_root, month, step)
            done = (len(step), staged.rows_read, staged.rows_accepted, staged.rows_rejected)
            counts = [a + b for a, b in zip(counts, done)]
    return ChangedResult(*counts)
