from hitroll.session import sizing_conf


def test_sizing_from_shuffled_bytes_not_input():
    conf = sizing_conf(100 << 40, total_cores=8000)
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 512 << 20
    # an eighth of 100 TiB in 256 MiB partitions, not one reducer per 256 MiB of input
    assert int(conf["spark.sql.shuffle.partitions"]) == 51200
    assert conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "51200"


def test_sizing_floor_and_measured_shuffle():
    assert int(sizing_conf(1 << 30, total_cores=8)["spark.sql.shuffle.partitions"]) == 16
    conf = sizing_conf(100 << 40, total_cores=8000, shuffle_bytes=2 << 40)
    assert int(conf["spark.sql.shuffle.partitions"]) == 16000


def test_a_cluster_must_name_a_shared_folder(monkeypatch, spark):
    import pytest

    from hitroll import session as SS

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        SS.shared_dir(Session())
    a, b = SS.scratch_path(spark, "x"), SS.scratch_path(spark, "x")
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]
