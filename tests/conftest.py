import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from skyvane.session import build_session, checkpoint_root
    s = build_session("local[4]", app="skyvane-tests", shuffle_partitions=4)
    checkpoint_root(s)
    yield s
    s.stop()
