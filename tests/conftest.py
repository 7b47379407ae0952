import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from eventlake.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=8, app_name="eventlake-tests",
                  extra={"spark.driver.memory": "6g",
                         "spark.checkpoint.dir": tempfile.mkdtemp(prefix="el-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="el-test-")
