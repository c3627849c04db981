import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tiercast.session import local_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def check_dir():
    return f"{DATA}/sf0.01"
