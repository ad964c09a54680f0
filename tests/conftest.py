import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from stridelake.session import checkpoint_root, get_session
    s = get_session("stridelake-tests", master="local[4]", shuffle_partitions=4)
    checkpoint_root(s)
    yield s
    s.stop()
