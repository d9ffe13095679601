import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from vellumry.session import build_session

    s = build_session(4, "tests", spark__sql__shuffle__partitions="4")
    yield s
    s.stop()
