import pytest

from starpipe.session import scratch_dir
from starpipe.sources.io import materialize, read_jdbc, scratch_scope


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, master):
        self.sparkContext, self.conf = _Context(master), _Conf()


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[3,2,1024]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(_Session(master))


@pytest.mark.parametrize("master", ["local", "local[*]", "local[8]"])
def test_one_machine_gets_a_folder(master):
    assert "starpipe-ckpt-" in scratch_dir(_Session(master))


def test_scope_leaves_nothing_behind(spark):
    with scratch_scope(spark):
        df = materialize(spark.range(10), "x")
        folder = df.inputFiles()[0].rsplit("/", 2)[0]
        assert df.count() == 10
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def test_partitioned_jdbc_read_needs_its_bounds(spark):
    with pytest.raises(ValueError, match="lower_bound"):
        read_jdbc(spark, "jdbc:x", "t", partition_column="id")
