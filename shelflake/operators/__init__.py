"""Row-set operators of the ingest, load and organize jobs."""

from .constraints import rejected, with_violations
from .listings import listings_of, parsed, responses_and_listings, typed_listings
from .losses import LOSSES, loss_counts, lost_values
from .organize import (
    already_organized,
    distinct_drops,
    files_behind,
    matched,
    not_organized,
    rows_of_files,
    unmatched,
)
from .status import category_status, status_lines, status_of_rows
from .surrogate import with_identity
from .warehouse_rows import warehouse_losses, warehouse_rows

__all__ = [
    "LOSSES",
    "already_organized",
    "category_status",
    "distinct_drops",
    "files_behind",
    "listings_of",
    "loss_counts",
    "lost_values",
    "matched",
    "not_organized",
    "parsed",
    "rejected",
    "responses_and_listings",
    "rows_of_files",
    "status_lines",
    "status_of_rows",
    "typed_listings",
    "unmatched",
    "warehouse_losses",
    "warehouse_rows",
    "with_identity",
    "with_violations",
]
