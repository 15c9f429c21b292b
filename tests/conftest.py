import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ordermill.session import local_session
    with tempfile.TemporaryDirectory(prefix="ordermill-test-ckpt-", ignore_cleanup_errors=True) as scratch:
        s = local_session(4, shuffle_partitions=4, app="ordermill-tests", extra={"spark.checkpoint.dir": scratch})
        yield s
        s.stop()
