import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]


@pytest.fixture(scope="session")
def spark():
    from keyflow.session import build_session
    session = build_session(master="local[4]", shuffle_partitions=8, app_name="keyflow-tests")
    yield session
    session.stop()
