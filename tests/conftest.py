import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelyard.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    session = local_session(4, memory="4g", **shared)
    yield session
    session.stop()
