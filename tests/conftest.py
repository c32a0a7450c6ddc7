import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rillet.session import build_session
    s = build_session(master="local[8]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "8g",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="rillet-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
