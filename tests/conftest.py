from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from access_spark.session import local_session

    session = local_session(4, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


def values(df, *columns):
    """Rows as sorted tuples."""
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))
