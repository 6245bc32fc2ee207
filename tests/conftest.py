import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from blockstrata.session import local_session, ship_package
    session = local_session(8)
    ship_package(session)
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("tables")))
    yield session
    session.stop()
