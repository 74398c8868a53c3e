import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from hirelake.session import build_session
    s = build_session("local[4]", 8, app="hirelake-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (optionally a column subset)."""
    d = df.select(*cols) if cols else df
    return [tuple(r) for r in d.collect()]
