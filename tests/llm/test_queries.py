"""The registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

from drydock.llm import queries

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("DRYDOCK_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables are absent")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(queries.ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    order = [names.index(x) for x in columns]
    rows = [tuple(r[x] for x in columns) for r in got.collect()]
    assert sorted(rows, key=str) == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=str)
