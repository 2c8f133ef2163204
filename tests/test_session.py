import pytest

from gridlake.session import DEFAULTS, build_session, checkpoint_dir, ensure_checkpoint_dir


def test_defaults_do_not_override_set_values(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    assert key in DEFAULTS
    old = spark.conf.get(key)
    spark.conf.set(key, "64m")
    try:
        s2 = build_session()
        assert s2 is spark
        assert s2.conf.get(key) == "64m"
        # explicit requests are applied
        build_session(extra={key: "32m"})
        assert spark.conf.get(key) == "32m"
    finally:
        spark.conf.set(key, old)


def test_a_local_master_gets_a_local_checkpoint_folder(spark):
    assert ensure_checkpoint_dir(spark) and checkpoint_dir(spark)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
