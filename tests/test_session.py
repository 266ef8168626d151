"""Where intermediate data goes."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from shelflake.session import SHARED_FOLDER_SETTING, shared_folder, work_path


def session(master, **settings):
    conf = {"spark.sql.warehouse.dir": "file:/opt/spark-warehouse/"} | settings
    return SimpleNamespace(conf=SimpleNamespace(get=lambda *a: conf.get(*a)), sparkContext=SimpleNamespace(master=master))


def test_the_folder_the_cluster_names():
    for master in ("local[4]", "spark://host:7077", "yarn"):
        named = session(master, **{SHARED_FOLDER_SETTING: "hdfs://x/shared/"})
        assert shared_folder(named) == "hdfs://x/shared"
        assert work_path(named, "rows").startswith("hdfs://x/shared/shelflake/rows-")


def test_the_warehouse_stands_in_where_it_is_shared():
    assert shared_folder(session("local[4]")) == "file:/opt/spark-warehouse/_shared"
    there = session("yarn", **{"spark.sql.warehouse.dir": "s3a://bucket/warehouse"})
    assert shared_folder(there) == "s3a://bucket/warehouse/_shared"


@pytest.mark.parametrize("warehouse", ["file:/opt/spark-warehouse", "/opt/spark-warehouse"])
@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host"])
def test_a_folder_of_the_machine_is_refused_on_a_cluster(master, warehouse):
    with pytest.raises(RuntimeError, match="names no shared folder"):
        shared_folder(session(master, **{"spark.sql.warehouse.dir": warehouse}))
