import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tabloom.session import get_session
    s = get_session(master="local[4]", partitions=8, driver_memory="4g")
    yield s
