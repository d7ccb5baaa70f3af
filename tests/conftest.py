import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from trendlens.session import build_session

    chk = tempfile.mkdtemp(prefix="trendlens-test-")
    s = build_session("local[8]", "trendlens-tests", shuffle_partitions=8,
                      **{"spark.checkpoint.dir": chk, "spark.driver.memory": "8g"})
    yield s
    s.stop()
