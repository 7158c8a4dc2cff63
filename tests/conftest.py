import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__  # noqa: E402,F401  (lets workers unpickle the packages)
from tests.session import make_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = make_session(partitions=4, cpus=4)
    yield session
    session.stop()
