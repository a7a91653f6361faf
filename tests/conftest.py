import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from martlake.session import build_session
    ckpt = tempfile.mkdtemp(prefix="martlake-test-ckpt-")
    s = build_session(master="local[4]", app="martlake-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="martlake-wh-")})
    yield s
    s.stop()
