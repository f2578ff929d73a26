import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from reviewgate.session import build_session
    s = build_session("local[4]", 4, app_name="reviewgate-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reviewgate-test-ckpt-"))
    yield s
    s.stop()
