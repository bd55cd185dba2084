import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabulary.session import local_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app_name="tabulary-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as plain tuples, in the given column order."""
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
