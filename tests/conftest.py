import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from driftloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, "tests", spark__checkpoint__dir=shared)
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a frame from columns; ``id`` numbers the rows."""

    def build(schema: str, **columns):
        n = len(next(iter(columns.values())))
        rows = list(zip(range(n), *columns.values()))
        return spark.createDataFrame(rows, f"id long, {schema}")

    return build
