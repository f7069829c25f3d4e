"""The training-data queries that SQL can express agree with it at sf0.001."""

from __future__ import annotations

import os

import pytest

from citeloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(str([r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    found = duck.execute(ORACLE_SQL[name])
    assert got == _canon([c[0] for c in found.description], found.fetchall())
