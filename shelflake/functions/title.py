"""Short form of a product title."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def short_title(title: Column) -> Column:
    """Text before the first comma; in titles without one, before the first bar.

    Nothing is trimmed: ``Foo | Bar`` gives ``Foo `` with its blank.
    """
    return F.when(title.contains(","), F.substring_index(title, ",", 1)).otherwise(
        F.substring_index(title, "|", 1)
    )
