import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from yearweave.session import local_session
    s = local_session(shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Collect selected columns as a list of tuples, in frame order."""
    return [tuple(r) for r in df.select(*cols).collect()]
