import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from barloom.session import local_session

    session = local_session("8", 4, **{"spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()
