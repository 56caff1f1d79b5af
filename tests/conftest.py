import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hitroll.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="hitroll-tests", shuffle_partitions=4)
    shared_dir(s)  # registers a private checkpoint folder when the session has none
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path(tmp_path):
    return str(tmp_path)
