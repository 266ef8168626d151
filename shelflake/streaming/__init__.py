"""Checkpointed incremental forms of the load and organize jobs."""

from .load import load_new_files
from .organize import organize_new_drops

__all__ = ["load_new_files", "organize_new_drops"]
