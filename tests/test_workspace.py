import os

from scrubline import workspace


def test_tables_are_stored_below_the_configured_folder(spark, frame):
    stored = workspace.written(frame([(1, "a"), (2, None)], "i int, s string"), "test")
    assert sorted(stored.collect()) == [(1, "a"), (2, None)]
    path = stored.inputFiles()[0]
    folder = workspace.shared_folder(spark).removeprefix("file:")
    assert folder in path and spark.sparkContext.applicationId in path
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or configured.rstrip("/") == workspace.shared_folder(spark)


def test_tables_of_a_block_are_deleted(spark, frame):
    outside = workspace.written(frame([(1,)], "i int"), "test")
    with workspace.scratch_tables(spark):
        inside = workspace.written(frame([(2,)], "i int"), "test")
        with workspace.scratch_tables(spark):
            workspace.written(frame([(3,)], "i int"), "test")
        path = inside.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path) and inside.first().i == 2
    assert not os.path.exists(path) and outside.first().i == 1


def test_clusters_need_a_shared_folder(monkeypatch):
    class Context:
        master = "yarn"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    try:
        workspace.shared_folder(Session())
    except RuntimeError as error:
        assert "spark.checkpoint.dir" in str(error)
    else:
        raise AssertionError("a cluster without a shared folder must be refused")
