import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stratus.session import build_session
    extra = {"spark.ui.showConsoleProgress": "false"}
    s = build_session("local[4]", app="stratus-tests", shuffle_partitions=4, extra=extra)
    s.sparkContext.setLogLevel("ERROR")
    # tests use the cluster's checkpoint folder when one is configured, else their own
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext._conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="stratus-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="stratus-test-")
