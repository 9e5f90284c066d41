import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from filegate.session import checkpoint_dir, local_session

    session = local_session(cores="*", shuffle_partitions=8, app="filegate-tests")
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    checkpoint_dir(session, default=f"file:{scratch}/checkpoints")
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
