import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from keyrelay.session import delete_dir, ensure_checkpoint_dir, get_session
    s = get_session(master="local[*]", shuffle_partitions=8)
    yield s
    # the scratch tree of this session only (the checkpoint folder is unique per application)
    delete_dir(s, ensure_checkpoint_dir(s).rstrip("/") + "/keyrelay")
    s.stop()
