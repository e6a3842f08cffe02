from types import SimpleNamespace

import pytest

from stratacast.session import materialize, scratch_path, session_setting, shared_dir


def _session(configured=None, current=None, master="local[2]"):
    state = {"dir": current}
    context = SimpleNamespace(
        master=master,
        getConf=lambda: SimpleNamespace(get=lambda key: configured),
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda path: state.update(dir=path),
    )
    return SimpleNamespace(sparkContext=context), state


def test_the_cluster_names_the_shared_folder():
    session, state = _session(configured="hdfs:///shared", master="yarn")
    assert shared_dir(session) == "hdfs:///shared" == state["dir"]


def test_a_cluster_without_the_setting_is_an_error():
    session, state = _session(master="yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session)
    assert state["dir"] is None


def test_a_local_session_gets_a_folder_once():
    session, state = _session()
    assert shared_dir(session) == shared_dir(session) == state["dir"]


def test_materialized_frames_are_files_in_the_shared_folder(spark):
    frame = materialize(spark.range(5), "numbers")
    assert frame.count() == 5
    assert all(shared_dir(spark) in f for f in frame.inputFiles())
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_written_frames_leave_no_shuffle_behind(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    counted = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    written = materialize(counted, "counted")
    assert spark.conf.get(key) == before
    # The same frame can be written and collected again.
    assert sorted(written.collect()) == sorted(materialize(counted, "again").collect())
    assert sorted(counted.collect()) == sorted(written.collect())


def test_a_session_setting_comes_back_after_an_error(spark):
    key = "spark.sql.files.maxRecordsPerFile"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), session_setting(spark, key, "5"):
        assert spark.conf.get(key) == "5"
        raise ValueError
    assert spark.conf.get(key) == before
