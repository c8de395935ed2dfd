import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark():
    from strandloom.session import get_session, ship

    session = get_session("tests", cpus=4, spark__sql__shuffle__partitions="4", spark__default__parallelism="4")
    ship(session)
    yield session
    session.stop()
