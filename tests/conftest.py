import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from benchlake.session import ensure_checkpoint_dir, local_session

    s = local_session("4", 8, app="benchlake-tests")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="benchlake-test-", dir="/tmp")
