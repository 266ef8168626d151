"""Session helpers: local sessions for tests and bench, and the shared work folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import SparkSession

from .files import remove_folder

SHARED_FOLDER_SETTING = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, app_name: str = "shelflake", **settings: str) -> SparkSession:
    """A local session. On a cluster use the session the cluster hands out instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("SHELFLAKE_DRIVER_MEMORY", "8g"))
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names, or else one in the warehouse.

    On a cluster whose warehouse is a folder of the machine there is none, and that is an error: what one
    executor writes there others do not find.
    """
    configured = spark.conf.get(SHARED_FOLDER_SETTING, None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and urlparse(warehouse).scheme in ("", "file"):
        raise RuntimeError(f"{SHARED_FOLDER_SETTING} names no shared folder, and the warehouse is none: {warehouse}")
    return f"{warehouse}/_shared"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder. Nothing is created yet."""
    return f"{shared_folder(spark)}/shelflake/{name}-{uuid.uuid4().hex}"


@contextmanager
def passing_path(spark: SparkSession, name: str) -> Iterator[str]:
    """A work path that is removed when the block ends."""
    path = work_path(spark, name)
    try:
        yield path
    finally:
        remove_folder(spark, path)
