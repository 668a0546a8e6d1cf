import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from linedocs.session import local_session

    ckpt = tempfile.mkdtemp(prefix="linedocs-test-ckpt-")
    s = local_session(4, shuffle_partitions=8, app="linedocs-tests",
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return tmp_path
