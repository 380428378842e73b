import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from reviewrank.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Many short plans: a light compiler and collector save more than they cost.
    session = local_session(4, 4, "4g", "-XX:TieredStopAtLevel=1 -XX:+UseSerialGC")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
