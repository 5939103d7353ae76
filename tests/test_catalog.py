"""Every query against its SQL on the smallest benchmark tables, and the shape of key plans."""

from __future__ import annotations

import os
import re
from decimal import Decimal

import pytest

from drydock.operators import lint, repos, rewrite, savings
from drydock.plans import catalog, frames, oracle

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("DRYDOCK_TEST_TABLES", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables are absent")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    return round(value, 6) if isinstance(value, float) else value


@needs_tables
@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_equals_sql(spark, sql, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    cur = sql.execute(oracle.ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in order) for r in cur.fetchall()), key=str)


@needs_tables
@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(oracle.ORACLE)))
def test_query_without_sql_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_oracle_names_are_queries():
    assert set(oracle.ORACLE) <= set(catalog.QUERIES)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_file_work_needs_no_shuffle(spark, tmp_path):
    frames.files(spark, SF).write.parquet(str(tmp_path / "files"))
    files = repos.build_files(spark.read.parquet(str(tmp_path / "files")))
    for df in (lint.instructions(files), lint.findings(files), rewrite.static_rewrite(files), savings.savings_in_row(files)):
        plan = plan_of(df)
        assert "Exchange" not in plan and "Python" not in plan
        assert "ReadSchema: struct<file_id:bigint,path:string,content:string>" in plan


@needs_tables
def test_native_queries_use_no_python(spark):
    python = {"model_call", "model_answers", "read_build_tree", "stream_chunk_reassembly"}
    light = [n for n in sorted(catalog.QUERIES) if not n.startswith("stream_") and n not in python | {"stage_texts", "result_csv", "run_metadata"}]
    for name in light:
        plan = plan_of(catalog.QUERIES[name](spark, SF))
        assert not re.search("PythonUDF|EvalPython|InPandas|InArrow", plan), name
