"""Keyed operators against plain windows and joins, with one key that holds most rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drydock.operators import mining, repos, skew


@pytest.fixture
def hot(spark):
    key = F.when(F.col("id") % 3 != 0, 0).when(F.col("id") % 7 != 6, F.col("id") % 7)  # some keys are null
    return spark.range(3000).select(
        key.alias("k"),
        ((F.col("id") * 7919) % 3001).alias("pos"),
        (F.col("id") % 11 - 3).alias("v"),
        F.when(F.col("id") % 5 == 0, F.concat(F.lit("x"), F.col("id").cast("string"))).otherwise(F.lit(" ")).alias("label"),
    )


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    left, right = (sorted(map(str, df.select(*cols).collect())) for df in (a, b))
    assert left == right


ORDERS = {
    "number": "pos",
    "text": "lpad(cast(pos as string), 6, '0')",
    "time": "timestamp_micros(pos * 1000000)",
    "time without zone": "cast(timestamp_micros(pos * 1000000) as timestamp_ntz)",
    "far outliers": "if(pos % 500 = 0, pos * 1000000000, pos)",
}


@pytest.mark.parametrize("kind", ORDERS)
@pytest.mark.parametrize("block_rows", [50, 10**6])
def test_ordered_work_equals_plain_windows(hot, kind, block_rows):
    rows = hot.withColumn("o", F.expr(ORDERS[kind])).withColumn("n", F.when(F.col("v") > 0, F.col("v")))
    w = W.partitionBy("k").orderBy("o")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    plain = rows.withColumn("cumulative", F.sum("v").over(upto)).withColumn("no", F.row_number().over(w).cast("long"))
    same(skew.running(rows, ["k"], ["o"], "v", number="no", block_rows=block_rows), plain)
    same(skew.previous(rows, ["k"], ["o"], "n", "b", block_rows), rows.withColumn("b", F.lag("n").over(w)))
    blank = rows.withColumn("label", F.nullif(F.trim("label"), F.lit("")))
    same(skew.forward_fill(rows, ["k"], ["o"], "label", block_rows), blank.withColumn("label", F.last("label", ignorenulls=True).over(upto)))


def test_forward_fill_without_keys(hot):
    whole = W.orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    blank = hot.withColumn("label", F.nullif(F.trim("label"), F.lit("")))
    same(skew.forward_fill(hot, [], ["pos"], "label", 64), blank.withColumn("label", F.last("label", ignorenulls=True).over(whole)))


@pytest.mark.parametrize("order", [["o"], ["same", "pos"]])
def test_blocks_are_even_when_the_order_is_not(spark, order):
    """Clustered values with far outliers, and one time for all rows: the largest block stays small."""
    rows = spark.range(40_000).select(
        F.col("id").alias("pos"), F.lit(7).alias("same"), F.when(F.col("id") % 4000 == 0, F.col("id") * 10**9).otherwise(F.col("id")).alias("o")
    )
    sizes = skew.with_blocks(rows, [], order, 1000).groupBy("_block").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < 10_000 and sizes[1] > 20


def test_first_and_top(hot):
    w = W.partitionBy("k").orderBy("pos")
    plain = hot.withColumn("rank", F.row_number().over(w))
    same(skew.top_per_key(hot, ["k"], [F.col("pos")], 5), plain.filter("rank <= 5"))
    same(skew.first_per_key(hot, ["k"], [F.col("pos")]), plain.filter("rank = 1").drop("rank"))


def test_first_is_cut_before_the_shuffle(hot):
    plan = skew.first_per_key(hot, ["k"], [F.col("pos")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_with_missing(spark):
    r = spark.createDataFrame([(1,), (2,), (2,), (3,)], "repo_id int")
    f = spark.createDataFrame([(1, "a"), (1, "b"), (9, "c")], "repo_id int, path string")
    rows = {tuple(x) for x in repos.with_missing(r, f).collect()}
    assert rows == {(1, "a", "ok"), (1, "b", "ok"), (2, None, "no_dockerfile"), (3, None, "no_dockerfile")}


def test_nth_and_sample(spark):
    df = spark.range(50).select((F.col("id") * 3).alias("x"))
    assert [r.x for r in repos.nth(df, F.col("x"), 3).collect()] == [6]
    assert repos.nth(df, F.col("x"), 51).count() == 0
    with pytest.raises(ValueError):
        repos.nth(df, F.col("x"), 0)
    one = {r.x for r in repos.hash_sample(df, F.col("x"), 20, seed=1).collect()}
    two = {r.x for r in repos.hash_sample(df.repartition(3), F.col("x"), 20, seed=1).collect()}
    assert one == two and len(one) == 20
    assert one != {r.x for r in repos.hash_sample(df, F.col("x"), 20, seed=2).collect()}


@pytest.fixture
def pr_tables(spark):
    prs = spark.createDataFrame(
        [("p", 1, 2, 1, 0), ("p", 1, 1, 1, 1), ("p", 2, 0, 1, 2), ("p", 3, 1, 0, 3), ("p", 4, 1, 1, 4), ("q", 4, 1, 1, 5), ("p", 5, 1, 1, 6)],
        "project string, pnumber int, n_files int, n_commits int, pos int",
    )
    diffs = spark.createDataFrame(
        [
            ("p", 1, "diff --git a/x.c b/x.c\n+1\ndiff --git a/run.sh b/run.sh\n+1"),
            ("p", 2, "diff --git a/a.sh b/a.sh"),
            ("p", 3, "diff --git a/a.sh b/a.sh"),
            ("p", 4, "diff --git a/old.c b/core/new.c"),
            ("q", 4, "diff --git a/core/x.txt b/core/x.txt"),
            ("p", 5, "diff --git a/my file b/my file\ndiff --git a/z.yml b/z.yml\n diff --git a/n b/n"),
        ],
        "project string, pnumber int, diff_text string",
    )
    patterns = spark.createDataFrame([("p", "core/"), ("p", " "), ("q", "core/")], "project string, pattern string")
    return prs, mining.changed_files(diffs), patterns


@pytest.mark.parametrize("length", [5, 1])
def test_select_prs(spark, pr_tables, monkeypatch, length):
    monkeypatch.setattr(mining, "GRAM", length)
    prs, files, patterns = pr_tables
    patterns = patterns.unionByName(spark.createDataFrame([("p", f"none{i}/") for i in range(20)], patterns.schema))
    rows = {(r.project, r.pnumber, r.pos) for r in mining.select_prs(prs, files, patterns).collect()}
    assert rows == {("p", 1, 0), ("p", 4, 4), ("p", 5, 6)}
    assert {tuple(r) for r in mining.matching_paths(files, patterns).collect()} == {("p", 4, "core/new.c")}


def test_first_row_decides_even_when_rejected(spark, pr_tables):
    _, files, patterns = pr_tables
    prs = spark.createDataFrame(
        [("p", 1, 9, 1, 0), ("p", 1, 2, 1, 1)], "project string, pnumber int, n_files int, n_commits int, pos int"
    )
    assert mining.select_prs(prs, files, patterns).count() == 0


@pytest.mark.parametrize(
    ("path", "ok"),
    [("docs/x", True), ("a/docs/x", False), ("xjpeg", False), ("a.md", False), ("a/Documentation/b", False), ("CMakeLists.txt", False), ("a.c", True)],
)
def test_counted_paths(spark, path, ok):
    from drydock.functions import paths

    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(paths.is_counted_path(F.col("p"))).first()[0] is ok


def test_many_patterns_of_a_project_meet_few_paths(spark):
    rng = random.Random(4)
    name = lambda: "".join(rng.choice("abcdefgh_") for _ in range(9))
    names = [name() for _ in range(4000)]
    files = [("p", k, f"src/{rng.choice(names)}/{name()}.cpp") for k in range(3000)] + [("p", 5, "src/x.cpp"), ("q", 5, "ci"), ("q", 6, "日本語の道")]
    df = spark.createDataFrame(files, "project string, pnumber int, path string")
    found = []
    for n in (2000, 4000):
        patterns = [("p", f"src/{x}/") for x in names[:n]] + [("q", "i"), ("q", "語"), ("q", "本語の道x"), ("q", " ")]
        pf = spark.createDataFrame(patterns, "project string, pattern string")
        want = {f for f in files if any(f[0] == p and t.strip() and t.strip() in f[2] for p, t in patterns)}
        assert {tuple(r) for r in mining.matching_paths(df, pf).collect()} == want
        found.append(mining.pattern_candidates(df, pf).count())
        plan = mining.pattern_candidates(df, pf)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert found[1] < 3 * len(files)
