import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from refinery.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(shuffle_partitions=8)
    # Tests own their session, so they may name a checkpoint folder when the
    # environment has none (a cluster always names a shared one).
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        d = tempfile.mkdtemp(prefix="refinery-test-ckpt-")
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="refinery-test-")
