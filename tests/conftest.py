from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from citeloom.session import build_session
    session = build_session(app="citeloom-tests", master="local[4]", shuffle_partitions=4)
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


def _key(t):
    return tuple((1, 0) if x is None else (0, x) for x in t)


def canon(seq):
    """Rows in a canonical order (NULLs last per column)."""
    return sorted((tuple(t) for t in seq), key=_key)


def rows(df, *cols):
    """Canonically ordered tuples of the given columns (all by default)."""
    cols = cols or tuple(df.columns)
    return canon(tuple(r[c] for c in cols) for r in df.collect())
