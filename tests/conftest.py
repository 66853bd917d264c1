import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from txnwatch.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", app_name="txnwatch-tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    # Tests own their checkpoint folder; a cluster names its shared one.
    checkpoint_dir(session, fallback=tempfile.mkdtemp(prefix="run-ckpt-", dir="/tmp"))
    yield session


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
