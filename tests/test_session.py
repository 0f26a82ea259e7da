"""The shared folder comes from the session; a cluster without one is an error."""

import pytest

from goldenrec.session import checkpoint_dir, concurrently, remove_folder, run_folder, stage


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, configured=None, folder=None):
        self.sparkContext, self.configured = _Context(master, folder), configured
        self.conf = self

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.configured or default


def test_the_configured_folder_is_used():
    session = _Session("spark://host", configured="s3a://shared/checkpoints")
    assert checkpoint_dir(session) == "s3a://shared/checkpoints" == session.sparkContext.folder
    assert checkpoint_dir(_Session("spark://host", folder="s3a://set/already")) == "s3a://set/already"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session("spark://host"))


def test_a_local_session_gets_a_scratch_folder():
    session = _Session("local[2]")
    assert checkpoint_dir(session) == checkpoint_dir(session)


def test_stored_tables_lie_in_the_run_folder(spark):
    stored = stage(spark.range(5), "numbers")
    assert stored.count() == 5
    assert run_folder(spark).removeprefix("file:").lstrip("/") in stored.inputFiles()[0]


def test_jobs_run_side_by_side_and_fail_loudly(spark):
    assert concurrently([lambda n=n: spark.range(n).count() for n in (3, 1, 2)]) == [3, 1, 2]

    def broken():
        raise RuntimeError("boom")

    with pytest.raises(RuntimeError, match="boom"):
        concurrently([broken, lambda: 1])


def test_intermediate_folders_can_be_removed(spark, tmp_path):
    path = str(tmp_path / "run")
    spark.range(5).write.parquet(f"{path}/numbers")
    remove_folder(spark, path)
    assert not (tmp_path / "run").exists()
