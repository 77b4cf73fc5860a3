import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from crossfade.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("crossfade-tests", cpus=4)
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
