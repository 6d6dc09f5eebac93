import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from chainlens.session import get_spark

    ckpt = tempfile.mkdtemp(prefix="chainlens-test-ckpt-")
    s = get_spark("local[4]", app="chainlens-tests",
                  conf={"spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
