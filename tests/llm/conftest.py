import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))

from headroom.session import get_session  # noqa: E402

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def table(spark):
    """Rows (doc_id, text[, lang, source]) as a documents table."""

    def make(rows, extra=""):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "a")), len(r[1] or ""), *r[4:]) for r in rows]
        return spark.createDataFrame(full, DOC + extra)

    return make


@pytest.fixture(scope="session")
def sf():
    path = "/root/testdata/sf0.001"
    if not pathlib.Path(path).exists():
        pytest.skip("driver tables are not here")
    return path
