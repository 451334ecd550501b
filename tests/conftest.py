import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ipscope.session import get_session
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = get_session("local[*]", shuffle_partitions=8)
    # Tests pick their own shared folder only where the session names none.
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(ckpt)
    yield s
