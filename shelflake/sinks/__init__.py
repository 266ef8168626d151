"""Writers: the lake in both layouts, the organized tree, the warehouse."""

from .lake import write_flat, write_partitioned
from .organized import write_organized
from .warehouse import create_table, insert_rows, publish_version, remove_left_over, reserve_ids

__all__ = [
    "create_table",
    "insert_rows",
    "publish_version",
    "remove_left_over",
    "reserve_ids",
    "write_flat",
    "write_organized",
    "write_partitioned",
]
