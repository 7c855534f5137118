import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from episcope.session import build_session, ensure_checkpoint_dir
    s = build_session("local[4]", app="episcope-tests", shuffle_partitions=4)
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="episcope-test-ckpt-"))
    yield s
    s.stop()
