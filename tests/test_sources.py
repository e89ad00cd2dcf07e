"""Reading remote tables is checked on a stand-in: no database is started for tests."""

from types import SimpleNamespace

import pytest

from reknit.session import drop_scratch, hadoop_path, materialize, measure, scratch_dir
from reknit.sources.publish import snapshot_from_catalog
from reknit.sources.tables import read_remote, stage


class Reader:
    def __init__(self, loads, bounds):
        self.loads, self.bounds, self.seen = loads, bounds, {}

    def format(self, name):
        return Reader(self.loads, self.bounds).options(format=name)

    def option(self, key, value):
        return self.options(**{key: value})

    def options(self, **more):
        self.seen.update(more)
        return self

    def load(self):
        self.loads.append(dict(self.seen))
        return SimpleNamespace(first=lambda: self.bounds)


def remote(bounds, **arguments):
    loads = []
    read_remote(SimpleNamespace(read=Reader(loads, bounds)), "jdbc:x", ["u.roles"], **arguments)
    return loads


def test_remote_in_one_read():
    (load,) = remote(None, properties={"user": "me"})
    assert load == {"format": "jdbc", "url": "jdbc:x", "user": "me", "dbtable": "u.roles"}


def test_remote_split_over_the_range():
    asked, load = remote(SimpleNamespace(lo=3, hi=90), split={"u.roles": ("id_role", 8)})
    assert asked["query"] == "SELECT min(id_role) AS lo, max(id_role) AS hi FROM u.roles"
    assert load["dbtable"] == "u.roles" and "query" not in load
    assert (load["partitionColumn"], load["lowerBound"], load["upperBound"],
            load["numPartitions"]) == ("id_role", 3, 90, 8)


def test_remote_split_of_an_empty_table():
    _, load = remote(SimpleNamespace(lo=None, hi=None), split={"u.roles": ("id_role", 8)})
    assert "partitionColumn" not in load


def test_stage_and_catalog(frame, spark):
    stage(frame("x long", (1,)), "staged")
    assert set(snapshot_from_catalog(spark, ["staged", "never_staged"])) == {"staged"}


def test_scratch_is_the_checkpoint_folder(spark):
    assert "checkpoints" in scratch_dir(spark)
    cluster = SimpleNamespace(
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="yarn",
                                     _jvm=spark._jvm, _jsc=spark.sparkContext._jsc),
        conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(cluster)


def test_measure(frame):
    assert measure(frame("a long, b string", (1, "xy"), (2, None))) == 18
    assert measure(frame("a long")) == 0


def test_drop_scratch_deletes_own_tables_only(spark, frame, tmp_path):
    other = tmp_path / "kept"
    frame("x long", (1,)).write.parquet(str(other))
    (file,) = materialize(frame("x long", (1,)).coalesce(1)).inputFiles()
    files, path = hadoop_path(spark, file)
    assert files.exists(path)
    drop_scratch(spark)
    assert not files.exists(path)
    assert spark.read.parquet(str(other)).count() == 1
