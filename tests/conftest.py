import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from recordloom.session import drop_staged, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", 4)
    yield session
    drop_staged(session)
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted plain tuples."""
    return lambda df: sorted((tuple(row) for row in df.collect()), key=repr)
