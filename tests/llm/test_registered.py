from __future__ import annotations

import re

import __spark_entry__ as entry


def test_every_operator_has_a_query():
    names = {m[1] for m in map(re.compile(r"op(\d+)_").match, entry.queries()) if m}
    assert names == {str(n) for n in range(1, 14)}
    assert "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
