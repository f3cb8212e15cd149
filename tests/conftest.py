import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from emberline.session import build_session
    scratch = tempfile.mkdtemp(prefix="emberline-tests-")
    s = build_session("local[4]", app="emberline-tests", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch} -XX:-DontCompileHugeMethods",
    })
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="emberline-t-")
