"""Scratch folders follow the session's setting."""

import pytest

from sluice.session import scratch_path


class Session:
    """The two settings that are read, in place of a cluster's session."""

    def __init__(self, master, folder):
        self._folder = folder
        self.conf = self.sparkContext = self
        self.master = master

    def get(self, name, default=None):
        return self._folder if name == "spark.checkpoint.dir" else default

    def getConf(self):
        return self


def test_scratch_is_below_the_shared_folder():
    session = Session("yarn", "hdfs:///shared/")
    first, second = scratch_path(session, "a"), scratch_path(session, "a")
    assert first.startswith("hdfs:///shared/a-") and first != second


def test_a_cluster_must_name_one():
    with pytest.raises(ValueError):
        scratch_path(Session("yarn", None), "a")


def test_a_local_session_may_not():
    assert scratch_path(Session("local[2]", None), "a")
