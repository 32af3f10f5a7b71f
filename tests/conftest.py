import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexgrid.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="lexgrid-tests-")
    s = build_session(master="local[*]", shuffle_partitions=8, scratch=scratch, driver_memory="8g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
