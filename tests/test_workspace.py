import os

import pytest

from larder import registry
from larder.workspace import (
    clear_scratch,
    scratch_dir,
    scratch_path,
    scratch_scope,
    session_database,
    stage,
)


class FakeSession:
    """Just the two settings the lookup reads."""

    def __init__(self, master, folder=None):
        self.folder = folder
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.applicationId = f"app-{id(self)}"

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.folder or default


def test_configured_folder_wins():
    assert scratch_dir(FakeSession("yarn", "hdfs://x/scratch/")) == "hdfs://x/scratch"


def test_no_folder_on_a_cluster_is_an_error():
    with pytest.raises(ValueError):
        scratch_dir(FakeSession("yarn"))


def test_local_master_has_one_of_its_own():
    session = FakeSession("local[2]")
    assert scratch_dir(session) == scratch_dir(session)


def test_paths_are_unique(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert scratch_path(spark, "a").startswith(scratch_dir(spark))


def test_scope_deletes_only_its_own(spark):
    kept = stage(spark.range(3), "kept")
    with scratch_scope(spark):
        dropped = stage(spark.range(4), "dropped")
        path = os.path.dirname(dropped.inputFiles()[0].removeprefix("file://"))
        assert os.path.exists(path) and dropped.count() == 4
    assert not os.path.exists(path)
    assert kept.count() == 3


def test_nothing_is_left_of_a_session(spark):
    """Registered queries leave nothing outside of the session's database, which can be dropped."""
    before = {d.name for d in spark.catalog.listDatabases()}
    tables = {t.name for t in spark.catalog.listTables("default")}
    folder = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    for name in ("layout_top_rated", "layout_plain", "curated_tables", "csv_split_landing"):
        registry.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert {t.name for t in spark.catalog.listTables("default")} == tables
    own = session_database(spark)
    assert {d.name for d in spark.catalog.listDatabases()} - before <= {own}
    assert os.listdir(folder)
    clear_scratch(spark)
    assert not os.path.exists(folder)
    assert own not in {d.name for d in spark.catalog.listDatabases()}
