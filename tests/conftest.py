import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from millrace.session import build_session

    session = build_session("millrace-tests", master="local[4]", shuffle_partitions=4)
    yield session
    session.stop()
