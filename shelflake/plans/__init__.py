"""The jobs: ingest, load, organize."""

from .changes import ChangedResult, load_changed_days
from .ingest import ingest
from .load import LoadResult, load_day, load_day_to_database
from .organize import OrganizeResult, organize

__all__ = [
    "ChangedResult",
    "LoadResult",
    "OrganizeResult",
    "ingest",
    "load_changed_days",
    "load_day",
    "load_day_to_database",
    "organize",
]
