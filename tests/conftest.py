import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tabulon.session import build_session

    s = build_session("local[4]", "tabulon-tests", shuffle_partitions=8)
    # Tests set their own shared folder only when the environment names none.
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tabulon-test-ckpt-"))
    yield s


@pytest.fixture()
def scratch(spark):
    from tabulon.session import scratch_path

    return scratch_path(spark, "test")
