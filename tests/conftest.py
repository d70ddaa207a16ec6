import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from firelog.session import local_session, scratch_root

    s = local_session(cores=4, shuffle_partitions=8, app="firelog-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        ckpt = tempfile.mkdtemp(prefix="firelog-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", ckpt)
        s.sparkContext.setCheckpointDir(ckpt)
    scratch_root(s)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="firelog-test-")
