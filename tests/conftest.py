import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from valora.session import get_session
    s = get_session("local[4]", app_name="valora-tests", shuffle_partitions=8)
    # use the checkpoint folder the environment names; only when none is
    # set do the tests get a scratch folder of their own
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="valora-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def duck():
    import duckdb
    return duckdb.connect()
