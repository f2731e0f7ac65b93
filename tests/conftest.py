import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="strata-tests", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as plain dicts, sorted for stable comparison."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    key = order or (lambda d: tuple(str(d[k]) for k in sorted(d)))
    return sorted(out, key=key)
