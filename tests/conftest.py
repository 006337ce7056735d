import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stockledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("stockledger-tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Builds a frame from rows and a DDL schema."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)
