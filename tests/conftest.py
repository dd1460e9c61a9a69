import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from synthtext.session import build_session, checkpoint_root

    s = build_session(app="synthtext-tests", master="local[*]", shuffle_partitions=8)
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def scratch(spark):
    from synthtext.session import scratch_path

    return scratch_path(spark, "tests")
