import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tideline.session import session

    conf = {"spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false", "spark.local.dir": tempfile.mkdtemp(prefix="spark-"), "spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="ckpt-"), "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="wh-")}
    s = session("local[4]", 4, **conf)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
