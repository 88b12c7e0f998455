"""The shared folder comes from the session; only a local session may do without."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from millrace.sources.workspace import shared_folder


def fake(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: folder if name == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_the_setting_is_used():
    path = shared_folder(fake("hdfs://store/shared/", "yarn"), "x")
    assert path.startswith("hdfs://store/shared/x-")
    assert path != shared_folder(fake("hdfs://store/shared/", "yarn"), "x")


def test_a_cluster_needs_it():
    with pytest.raises(ValueError):
        shared_folder(fake(None, "spark://host:7077"), "x")


def test_a_local_session_has_its_own():
    path = shared_folder(fake(None, "local[2]"), "x")
    assert os.path.isdir(os.path.dirname(path))
