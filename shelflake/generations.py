"""Small datasets that are rewritten as a whole: each time as a new generation beside the old one.

A generation counts from the moment its mark is there, which is one file creation. So a run that stops
leaves the old one in use, and readers never see half of a new one. The one before is kept for those who
are reading it; older ones are removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from .files import mark, names_in, path_exists, remove_folder

_WHOLE = "_whole"


def _numbered(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    names = (name for name in names_in(spark, root) if name.startswith("g") and name[1:9].isdigit())
    return sorted((int(name[1:9]), f"{root}/{name}") for name in names)


def newest_generation(spark: SparkSession, root: str) -> str | None:
    """The folder in use."""
    for _, folder in reversed(_numbered(spark, root)):
        if path_exists(spark, f"{folder}/{_WHOLE}"):
            return folder
    return None


def write_generation(
    spark: SparkSession, root: str, write: Callable[[str], None], note: str = ""
) -> str:
    """Let ``write`` fill the folder of the next generation and put it to use. The name ends in ``note``."""
    there = _numbered(spark, root)
    before = newest_generation(spark, root)
    number = there[-1][0] + 1 if there else 1
    folder = f"{root}/g{number:08d}{note}"
    write(folder)
    mark(spark, f"{folder}/{_WHOLE}")
    for _, old in there:
        if old != before:
            remove_folder(spark, old)
    return folder
