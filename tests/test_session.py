"""Where scratch tables go."""

from types import SimpleNamespace

import pytest

from lakesearch.session import work_path


def _session(master, folder=None):
    return SimpleNamespace(sparkContext=SimpleNamespace(master=master),
                           conf=SimpleNamespace(get=lambda key, default: folder or default))


def test_named_folder_is_used():
    path = work_path(_session("spark://host:7077", "hdfs://shared/"), "x")
    assert path.startswith("hdfs://shared/lakesearch/x-")


def test_only_a_local_session_falls_back():
    assert work_path(_session("local[2]"), "x") != work_path(_session("local[2]"), "x")
    with pytest.raises(ValueError):
        work_path(_session("yarn"), "x")
