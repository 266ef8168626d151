"""The business clock: one ``as_of`` instant per run, moved by a fixed offset.

A run reads its clock once. Column, partition key and day filter all derive from
that one value, so a run close to midnight cannot split over two days.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import OFFSET_HOURS


def _shifted(as_of: datetime | None, offset_hours: int) -> datetime:
    if as_of is None:
        as_of = datetime.now(timezone.utc)
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return as_of + timedelta(hours=offset_hours)


def business_day(as_of: datetime | None = None, offset_hours: int = OFFSET_HOURS) -> date:
    """The calendar day the run belongs to. A naive ``as_of`` is taken as UTC."""
    return _shifted(as_of, offset_hours).date()


def business_time(as_of: datetime | None = None, offset_hours: int = OFFSET_HOURS) -> Column:
    """The zone-less fetch time as a literal column.

    Built from text: a Python datetime would pass through the machine's own zone.
    """
    text = _shifted(as_of, offset_hours).isoformat(sep=" ", timespec="microseconds")
    return F.lit(text).cast("timestamp_ntz")


def _padded(part: Column, width: int) -> Column:
    return F.lpad(part.cast("string"), width, "0")


def lake_keys(ts: Column) -> dict[str, Column]:
    """``year``, ``month`` and ``day`` as zero-padded text.

    Uses the calendar functions, which read a zone-less timestamp directly, and not
    ``date_format``, which would go through the session zone.
    """
    return {
        "year": _padded(F.year(ts), 4),
        "month": _padded(F.month(ts), 2),
        "day": _padded(F.day(ts), 2),
    }


def day_key(ts: Column) -> Column:
    """The day as ``yyyymmdd`` text."""
    return F.concat(*lake_keys(ts).values())
