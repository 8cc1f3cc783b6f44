import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
# Python workers import the detectors of the library and of the tests.
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(HERE), HERE, os.environ.get("PYTHONPATH", "")])

from veilframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", 4)
    yield session
    session.stop()
