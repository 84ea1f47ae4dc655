import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from tapedeck.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="4g", partitions=3)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SMALL).is_dir():
        pytest.skip("driver tables not present")
    return SMALL


@pytest.fixture
def one(spark):
    """Evaluate columns over a single row."""

    def run(*columns):
        return tuple(spark.range(1).select(*columns).first())

    return run
