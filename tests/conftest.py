import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from linkloom.runtime import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(app="tests")
    yield session
    session.stop()
