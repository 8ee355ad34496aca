import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from starmart.session import build_session

    os.environ.setdefault("STARMART_TMP", tempfile.mkdtemp(prefix="run-tests-", dir="/tmp"))
    s = build_session("local[4]", app_name="starmart-tests", shuffle_partitions=8)
    yield s
    s.stop()
