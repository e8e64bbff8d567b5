import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from sentrail.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="8", app="sentrail-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("test tables not present")
    return folder


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="sentrail-test-")


@pytest.fixture(scope="session")
def activity(spark, sf):
    """The daily aggregate of the test tables, written once."""
    from registry.queries import written_activity

    return written_activity(spark, sf)
