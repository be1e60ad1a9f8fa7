import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sojourn.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[*]", shuffle_partitions=8)
    yield s


def rows(df, order=None):
    """Collected rows as sorted tuples."""
    return sorted(tuple(r) for r in df.collect()) if order is None else [tuple(r) for r in df.orderBy(*order).collect()]
