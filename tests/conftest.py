import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="tidewater-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
