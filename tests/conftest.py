import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from laketier.session import local_session
    s = local_session(cpus=8, shuffle_partitions=8, app_name="laketier-tests")
    yield s


@pytest.fixture()
def workdir():
    """A fresh folder per test (never cleared by the tests)."""
    return tempfile.mkdtemp(prefix="laketier-test-")
