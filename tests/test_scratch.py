"""Where intermediate tables go."""

import pathlib

import pytest

from barloom.sources import scratch


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, setting=None, folder=None):
        self.sparkContext = Context(master, folder)
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}


def test_the_setting_is_used():
    assert scratch.shared_folder(Session("yarn", "hdfs://shared/x/")) == "hdfs://shared/x"


def test_a_folder_set_on_the_context_is_used():
    assert scratch.shared_folder(Session("yarn", folder="hdfs://shared/y")) == "hdfs://shared/y"


def test_a_cluster_without_one_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session("spark://host:7077"))


def test_a_local_session_gets_one_and_keeps_it():
    session = Session("local[2]")
    folder = scratch.shared_folder(session)
    assert scratch.shared_folder(session) == folder


def test_paths_differ():
    session = Session("local", "/shared")
    assert scratch.new_path(session, "a") != scratch.new_path(session, "a")


def test_materialize_reads_back_the_same(spark):
    df = spark.range(5).withColumnRenamed("id", "n")
    kept = scratch.materialize(df, "five")
    assert kept.schema.names == ["n"]
    assert sorted(r.n for r in kept.collect()) == [0, 1, 2, 3, 4]
    assert "Range" not in kept._jdf.queryExecution().executedPlan().toString()


def test_clear_deletes_what_was_written_and_nothing_else(spark, tmp_path):
    scratch.clear(spark)
    spark.range(3).write.parquet(str(tmp_path / "other"))
    (path,) = scratch.materialize(spark.range(5), "five").inputFiles()[:1]
    scratch.new_path(spark, "never-written")
    assert scratch.clear(spark) == 1 and scratch.clear(spark) == 0
    assert not pathlib.Path(path.removeprefix("file://")).exists()
    assert spark.read.parquet(str(tmp_path / "other")).count() == 3
