import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tickvault.session import get_session
    ckpt = tempfile.mkdtemp(prefix="tickvault-test-ckpt-")
    s = get_session("local[4]", 4, app_name="tickvault-tests",
                    extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tickvault-test-")
