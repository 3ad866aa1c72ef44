import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from headroom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not pathlib.Path(SMALL).exists():
        pytest.skip("driver tables are not here")
    return SMALL
