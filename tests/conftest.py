import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lodestar.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8, app_name="lodestar-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lodestar-test-ckpt-"))
    yield s
    s.stop()

