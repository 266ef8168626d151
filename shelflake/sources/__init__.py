"""Readers: response envelopes, the partitioned lake, flat drops, the organized tree."""

from .envelopes import read_envelopes
from .flat import drop_files, read_flat
from .lake import read_day, read_lake, register_lake
from .missing import empty_frame, matches_or_empty, read_or_empty
from .organized import close_days, compact_manifest, organized_keys, read_organized

__all__ = [
    "close_days",
    "compact_manifest",
    "drop_files",
    "empty_frame",
    "matches_or_empty",
    "organized_keys",
    "read_day",
    "read_envelopes",
    "read_flat",
    "read_lake",
    "read_or_empty",
    "read_organized",
    "register_lake",
]
