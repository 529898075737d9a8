import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from digestflow.session import build_session, ship

    session = build_session("tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()


DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def data_dir():
    if not Path(DATA).exists():
        pytest.skip("no test data here")
    return DATA
