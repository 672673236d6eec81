import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from linkloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("4", 4)
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a small table: ``rows(schema, [...])``."""

    def build(schema, data):
        return spark.createDataFrame(data, schema)

    return build
