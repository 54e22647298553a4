"""Checkpoint folder resolution."""

import os

import pytest

from daycast import session


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default

    def set(self, key, value):  # a running session refuses static settings
        raise RuntimeError("CANNOT_MODIFY_CONFIG")


class _NoContext:
    """A session whose conf has no checkpoint dir and no SparkContext (Connect-like)."""

    session_id = "s-1"

    def __init__(self, value=None):
        self.conf = _Conf(value)

    @property
    def sparkContext(self):
        raise RuntimeError("no SparkContext")


def test_configured_dir_is_read_not_changed():
    assert session.checkpoint_dir(_NoContext("/shared/ckpt")) == "/shared/ckpt"


class _Context:
    applicationId = "app-1"

    def __init__(self, master):
        self.master = master


class _Session(_NoContext):
    def __init__(self, master):
        super().__init__()
        self.context = _Context(master)

    @property
    def sparkContext(self):
        return self.context


def test_unset_dir_is_an_error_off_the_local_machine():
    for s in (_NoContext(), _Session("spark://host:7077"), _Session("yarn"), _Session("local-cluster[2,1,1024]")):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.checkpoint_dir(s)


def test_local_session_gets_one_private_folder():
    a, b = session.checkpoint_dir(_Session("local[2]")), session.checkpoint_dir(_Session("local"))
    assert a == b and os.path.isdir(a)


def test_stage_paths_keep_their_length_and_can_be_removed(spark):
    df = spark.range(1)
    lengths = {len(session.scratch_path(spark, "x")) for _ in range(500)}
    a = session.stage(df, "probe")
    path = a._daycast_stage
    assert len(lengths) == 1 and a.count() == 1 and os.path.isdir(path.replace("file:", ""))
    session.drop_stage(a)
    assert not os.path.exists(path.replace("file:", ""))


def test_real_session_uses_its_setting(spark):
    assert session.checkpoint_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or
                                             session.checkpoint_dir(spark))
