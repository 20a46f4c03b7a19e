import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wireloom.session import local_session  # noqa: E402
from wireloom.sources.store import NewsStore  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "wireloom-tests")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return NewsStore(spark, str(tmp_path / "store"))
