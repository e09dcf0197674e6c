from pathlib import Path

import pytest

from syncspark.workspace import new_path, scratch, shared_dir, stage


def test_paths_are_new_and_below_the_shared_folder(spark):
    paths = {new_path(spark, "x") for _ in range(5)}
    assert len(paths) == 5 and all(p.startswith(shared_dir(spark)) for p in paths)


def test_staged_table_is_read_from_files(spark, rows):
    staged = stage(spark.range(3).selectExpr("id", "CAST(NULL AS STRING) AS s"), "t")
    assert rows(staged) == [(0, None), (1, None), (2, None)]
    assert "FileScan parquet" in staged._jdf.queryExecution().executedPlan().toString()
    assert len(staged.inputFiles()) > 0


def test_scratch_is_deleted_also_after_an_error(spark):
    def folders():
        # Staged files lie two levels below the scratch folder's parent.
        return {str(Path(f.removeprefix("file:")).parent) for f in staged.inputFiles()}

    with scratch(spark):
        staged = stage(spark.range(10), "t")
        inside = folders()
        assert all(Path(f).exists() for f in inside)
    assert not any(Path(f).exists() for f in inside)
    with pytest.raises(RuntimeError):
        with scratch(spark):
            staged = stage(spark.range(10), "t")
            inside = folders()
            raise RuntimeError("stop")
    assert not any(Path(f).exists() for f in inside)


class Context:
    """Just enough of a context whose cluster names no shared folder."""

    def __init__(self, master):
        self.master = master
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, configured=None):
        self.sparkContext = Context(master)
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}


def test_missing_setting_is_an_error_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session("yarn"))


def test_setting_of_the_cluster_is_used():
    assert shared_dir(Session("yarn", "hdfs://name/shared/")) == "hdfs://name/shared"


def test_local_session_stages_below_the_warehouse():
    session = Session("local[2]")
    session.conf["spark.sql.warehouse.dir"] = "/shared/warehouse/"
    assert shared_dir(session) == "/shared/warehouse/_staged"


def test_kept_table_outlives_the_innermost_block_only(spark):
    with scratch(spark):
        with scratch(spark):
            kept = stage(spark.range(4), "kept", keep=True)
        assert kept.count() == 4
        folder = Path(kept.inputFiles()[0].removeprefix("file:")).parent
    assert not folder.exists()
