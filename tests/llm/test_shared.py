"""Shared helpers: the folder for intermediate tables, groups over batches."""

import pyarrow as pa
import pytest

from headway.llm.shared import grouped, shared_folder, sliced


class Session:
    """As much of a session as `shared_folder` asks for."""

    def __init__(self, master, **settings):
        self.settings, self.master = settings, master
        self.conf = self.sparkContext = self._jsc = self
        self.isDefined, self.sc, self.getCheckpointDir = (lambda: False), (lambda: self), (lambda: self)

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_a_cluster_must_name_the_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("local-cluster[2,1,1024]"))
    assert shared_folder(Session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/"})) == "hdfs://shared"
    local = Session("local[4]")
    assert shared_folder(local) == shared_folder(local) == local.settings["spark.checkpoint.dir"]


def test_groups_cross_batches_and_slices_are_bounded():
    keys = [(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1), (5, 0)]
    whole = pa.table({"a": [a for a, _ in keys], "b": [b for _, b in keys], "x": list(range(7))})
    for size in (1, 2, 3, 7):
        batches = [pa.RecordBatch.from_pylist([])] if size == 0 else whole.to_batches(max_chunksize=size)
        assert [g["x"].to_pylist() for g in grouped(batches, ["a", "b"])] == [[0, 1], [2], [3, 4, 5], [6]]
    assert list(grouped([], ["a"])) == []
    batch = pa.record_batch({"text": ["abcdefgh"] * 10})
    assert [b.num_rows for b in sliced([batch, batch.slice(0, 0)], "text", 1 << 20, most=4)] == [4, 4, 2]
