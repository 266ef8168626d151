"""What a file's path says about it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import FILE_PREFIX, FLAT_KEY

EXTENSION = ".parquet"


def decoded(text: Column) -> Column:
    """Undo percent encoding. A literal plus sign stays a plus sign."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def file_name(path: Column) -> Column:
    """Last segment of a path."""
    return F.substring_index(path, "/", -1)


def without_extension(name: Column) -> Column:
    shorter = F.left(name, F.length(name) - len(EXTENSION))
    return (
        F.when(name.endswith(EXTENSION), shorter)
        # The pattern also finds the ending in front of a line break that is the last character.
        .when(name.contains(EXTENSION), F.regexp_replace(name, rf"\Q{EXTENSION}\E$", ""))
        .otherwise(name)
    )


def file_key(path: Column) -> Column:
    """Name of the drop a data file belongs to.

    A drop is a single file ``<key>.parquet``, a folder of that name with data files in it,
    or a folder ``snapshot_key=<key>`` as the flat sink writes it. Names of the last carry Spark's own
    escapes, undone here.

    A scan tells this for each row, so the path is cut at its slashes: patterns that look for its end
    try every character of it.
    """
    name = file_name(path)
    last_two = F.substring_index(path, "/", -2)
    folder = F.substring_index(last_two, "/", 1)
    # A folder's name stands between two slashes, and a file's name comes after it.
    inside = (last_two != path) & (name != "")
    named = f"{FLAT_KEY}="
    return (
        F.when(
            inside & folder.startswith(named) & (folder != named),
            decoded(F.substr(folder, F.lit(len(named) + 1))),
        )
        .when(inside & folder.endswith(EXTENSION) & (folder != EXTENSION), without_extension(folder))
        .otherwise(without_extension(name))
    )


def category_of(key: Column, prefix: str = FILE_PREFIX) -> Column:
    """Category inside ``<prefix>_<category>_<day>``; empty text if there is none.

    The category ends at the first underscore.
    """
    begins = f"{prefix}_"
    rest = F.substr(key, F.lit(len(begins) + 1))
    category = F.substring_index(rest, "_", 1)
    # Most keys begin so; the pattern finds the prefix anywhere else.
    return F.when(
        key.startswith(begins) & (category != "") & (category != rest), category
    ).otherwise(F.regexp_extract(key, rf"\Q{prefix}\E_([^_]+)_", 1))
