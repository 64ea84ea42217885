import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from treille.plans.session import local_session, ship_package

    session = local_session(4, "4g", spark__sql__shuffle__partitions="4")
    ship_package(session)
    yield session
    session.stop()
