from __future__ import annotations

import os
import sys
import time
import uuid
from pathlib import Path

os.environ["TZ"] = "UTC"
time.tzset()

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import pytest  # noqa: E402

from shelflake.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Four threads; a task may be tried three times.
    session = local_session(
        "4,3",
        "tests",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("catalog")),
        spark__sql__shuffle__partitions="4",
    )
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "data")


@pytest.fixture
def count_jobs(spark):
    """Number of Spark jobs an action starts."""

    def count(action) -> int:
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, group)
        try:
            action()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    return count
