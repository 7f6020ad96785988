import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cellwatch.config import build_session
    ckpt = tempfile.mkdtemp(prefix="cellwatch-test-ckpt-")
    s = build_session("local[*]", app="cellwatch-tests", shuffle_partitions=8,
                      **{"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
