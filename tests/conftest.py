import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lodeframe.session import build_session

    session = build_session("tests", cores=8, shuffle_partitions=8, driver_memory="6g")
    yield session
    session.stop()
