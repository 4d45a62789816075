import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from supplyscope.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app="supplyscope-tests")
    yield s


SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
