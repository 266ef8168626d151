"""Makes this package known to the Python workers, wherever the session runs them."""

from __future__ import annotations

import tempfile
import zipfile
from functools import wraps
from pathlib import Path
from weakref import WeakSet

from pyspark import SparkContext
from pyspark.sql import SparkSession

_ready: WeakSet[SparkContext] = WeakSet()

#: Rows go to the Python workers in batches of about this size, so that long texts do not fill them.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
_DEFAULT_BYTES = 64 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the size of batches, where the session has Spark's own default."""
    if spark.conf.get(BATCH_SETTING).rstrip("b") == str(_DEFAULT_BYTES):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def ship(spark: SparkSession) -> None:
    """Hand the package's modules to Spark, once for each context. Spark serves them to its
    executors.
    """
    context = spark.sparkContext
    if context in _ready:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="shelflake-code-")) / "shelflake_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _ready.add(context)


def shipped(query):
    """A query or stage whose first argument is the session, with the package shipped before it."""

    @wraps(query)
    def run(spark: SparkSession, *args, **options):
        ship(spark)
        bound_batches(spark)
        return query(spark, *args, **options)

    return run
