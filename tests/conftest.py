import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session, shared_dir
    s = build_session("local[*]", app_name="ledgerline-tests", shuffle_partitions=8)
    shared_dir(s)  # registers a private checkpoint folder only if none is configured
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE_DIR
