import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from opslens.session import build_session, checkpoint_root  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", app="opslens-tests", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    checkpoint_root(session)  # a private checkpoint dir only because none is configured
    yield session
    session.stop()
