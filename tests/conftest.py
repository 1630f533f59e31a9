import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cohortkit.runtime import local_session

    s = local_session("*", shuffle_partitions=8, app="cohortkit-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
