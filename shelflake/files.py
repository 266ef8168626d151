"""The few file-system calls Spark's reader and writer do not offer."""

from __future__ import annotations

import errno
import os
import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def literal_path(path: str) -> str:
    """A path that is not a pattern, whatever characters it has."""
    return re.sub(r"[\[\]{}*?\\]", r"\\\g<0>", path)


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _resolve(spark, path)
    return file_system.exists(hadoop_path)


def same_place(spark: SparkSession, one: str, other: str) -> bool:
    """Whether two paths mean the same place, however they are written."""
    qualified = []
    for path in (one, other):
        file_system, hadoop_path = _resolve(spark, path)
        qualified.append(file_system.makeQualified(hadoop_path).toString().rstrip("/"))
    return qualified[0] == qualified[1]


def resolved(spark: SparkSession, path: str) -> str:
    """The whole path, scheme and all."""
    file_system, hadoop_path = _resolve(spark, path)
    return file_system.makeQualified(hadoop_path).toString()


def any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether a path pattern matches anything. Lists what the pattern itself spans."""
    file_system, hadoop_path = _resolve(spark, pattern)
    return bool(file_system.globStatus(hadoop_path))


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    file_system, hadoop_path = _resolve(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in file_system.listStatus(hadoop_path)]


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern matches."""
    file_system, hadoop_path = _resolve(spark, pattern)
    return [status.getPath().toString() for status in file_system.globStatus(hadoop_path) or ()]


def make_folder(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _resolve(spark, path)
    file_system.mkdirs(hadoop_path)


def mark(spark: SparkSession, path: str) -> None:
    """Create a small file, or replace the one that is there. Its name is what it tells."""
    file_system, hadoop_path = _resolve(spark, path)
    file_system.create(hadoop_path, True).close()


def renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder to a name that is not taken; whether it was still there to be renamed.

    Of two who rename the same source at once, one succeeds.
    """
    file_system, hadoop_source = _resolve(spark, source)
    _, hadoop_target = _resolve(spark, target)
    if file_system.getScheme() == "file":
        # Hadoop's local file system looks first and renames then, which is not one step.
        try:
            os.rename(hadoop_source.toUri().getPath(), hadoop_target.toUri().getPath())
        except OSError as problem:
            if problem.errno in (errno.ENOENT, errno.ENOTEMPTY, errno.EEXIST):
                return False
            raise
        return True
    try:
        return file_system.rename(hadoop_source, hadoop_target)
    except Py4JJavaError:
        if file_system.exists(hadoop_source):
            raise
        return False


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there, that this package has written."""
    file_system, hadoop_path = _resolve(spark, path)
    file_system.delete(hadoop_path, True)


def remove_if_bare(spark: SparkSession, path: str) -> bool:
    """Remove a folder of which only hidden files are left; whether it was one."""
    if any(not name.startswith(("_", ".")) for name in names_in(spark, path)):
        return False
    remove_folder(spark, path)
    return True
