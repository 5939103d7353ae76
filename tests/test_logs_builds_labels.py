from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from drydock.operators import buildlogs, labels, logs


def test_contexts_agree(spark):
    text = "\n".join(["a", "b docker", "c", "", "DOCKERd x", "f"])
    df = spark.createDataFrame([("s", text), ("t", "none"), ("u", "buildkit")], "source string, content string")
    one = sorted(map(tuple, logs.context_in_text(df, radius=1).collect()))
    two = sorted(map(tuple, logs.context_in_lines(logs.number_lines(df), radius=1).collect()))
    assert one == two == [
        ("s", 2, 1, "", "a"), ("s", 2, 2, "*", "b docker"), ("s", 2, 3, "", "c"),
        ("s", 5, 4, "", ""), ("s", 5, 5, "*", "DOCKERd x"), ("s", 5, 6, "", "f"), ("u", 1, 1, "*", "buildkit"),
    ]


def test_overlapping_contexts_repeat_lines(spark):
    df = spark.createDataFrame([("s", "docker\ndocker")], "source string, content string")
    assert logs.context_in_text(df, radius=10).count() == 4


def extract(spark, lines):
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines)], "build_id int, n int, line string")
    r = buildlogs.extract(df, ["n"]).first()
    return r.step_count, r.final_size


@pytest.mark.parametrize(
    ("lines", "expected"),
    [
        (["Step 1/2 : FROM a", "12 MB", "Step 2/2 : RUN b", "1.5 GB total"], (2, "1.5 GB")),
        (["12 MB", "Successfully tagged x", "no size"], (0, None)),
        (["12 MB", "Successfully tagged x", "size 3 KB of 1 MB"], (0, "3 KB")),
        (["5 MB", "MB alone", "GB"], (0, "5 MB")),
        (["only 3 KB"], (0, None)),
        (["Step one", "1/2"], (0, None)),
    ],
)
def test_extract(spark, lines, expected):
    assert extract(spark, lines) == expected


def test_tail(spark):
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate("a,b,,d,e,f,  ".split(","))], "build_id int, n int, line string")
    assert [(r["rank"], r.line) for r in buildlogs.tail(df, ["n"]).orderBy("rank").collect()] == [(2, "f"), (3, "e"), (4, "d")]


def test_outcomes(spark):
    df = spark.createDataFrame([(1, 0, 1.234, None), (2, 1, 2.0, "boom"), (3, None, 400.0, None)], "build_id int, return_code int, seconds double, stderr string")
    rows = {r.build_id: (r.success, r.build_seconds) for r in buildlogs.outcomes(df).collect()}
    assert rows == {1: (True, 1.23), 2: (False, 2.0), 3: (False, 300.0)}
    assert {r.build_id for r in buildlogs.failed_builds(buildlogs.outcomes(df)).collect()} == {2, 3}


def test_batch_status(spark):
    df = spark.createDataFrame([(1, True, True, None), (2, True, False, None), (3, True, False, False)], "file_id int, stage_ok boolean, test_skipped boolean, test_success boolean")
    assert {(r.test_status, r.all_ok) for r in buildlogs.status_rollup(df).collect()} == {("skipped", True), ("unknown", True), ("failed", False)}
    assert buildlogs.batch_ok(df).first()[0] is False
    assert buildlogs.batch_ok(df.filter("file_id < 3")).first()[0] is True
    assert buildlogs.batch_ok(df.limit(0)).first()[0] is True


def test_kappa(spark):
    pairs = [("Y", "Y")] * 20 + [("Y", "N")] * 5 + [("N", "Y")] * 10 + [("N", "N")] * 15 + [("Y", None)]
    df = spark.createDataFrame([("q", a, b) for a, b in pairs] + [("one", "Y", "Y")], "question string, rater1 string, rater2 string")
    rows = {r.question: r for r in labels.kappa(df).collect()}
    assert (rows["q"].n_items, rows["q"].observed, rows["q"].expected, rows["q"].kappa) == (50, 0.7, 0.5, 0.4)
    assert rows["one"].kappa is None


def test_taxonomy(spark):
    df = spark.createDataFrame([("A_x", 2, "YES"), ("A_y_z", 3, "NO"), ("B", 1, "NO")], "label string, freq int, is_new string")
    rows = {(r.level1, r.level2, r.depth, r.freq, r.n_labels, r.n_new) for r in labels.taxonomy_rollup(df).collect()}
    assert rows == {
        ("(all)", "(all)", 0, 6, 3, 1), ("A", "(all)", 1, 5, 2, 1), ("B", "(all)", 1, 1, 1, 0),
        ("A", "x", 2, 2, 1, 1), ("A", "y", 2, 3, 1, 0), ("B", "-", 2, 1, 1, 0),
    }


def test_relations(spark):
    df = spark.createDataFrame([(0, "a", "x"), (1, "", "y"), (2, None, "y"), (3, "b", "x")], "row_no int, left_label string, right_label string")
    filled = labels.fill_relations(df, "row_no")
    assert [r.left_label for r in filled.orderBy("row_no").collect()] == ["a", "a", "a", "b"]
    assert {tuple(r) for r in labels.relation_counts(filled, "left_label", "right_label").collect()} == {("a", "x", 1), ("a", "y", 2), ("b", "x", 1)}


def test_size_reduction(spark):
    rows = [("a", "11.4GB", "8.38GB", "BUILD_FAILED"), ("b", "1.39GB", "NO_OPTIMIZATIONS", "1.39GB"), ("c", "332MB", "450 MB", "450MB"), ("d", "N/A", "?", "N/A")]
    out = labels.size_reduction(spark.createDataFrame(rows, "repo string, before string, static string, final string"))
    got = {r.repo: (r.ratio, r.static_status, r.final_status) for r in out.collect()}
    assert got == {
        "a": (0.7351, "measured", "build_failed"), "b": (1.0, "no_optimizations", "measured"),
        "c": (1.3554, "measured", "measured"), "d": (None, "unknown", "n/a"),
    }
    s = labels.reduction_summary(out).first()
    assert (s.n_images, s.n_measured, s.n_grown, s.n_shrunk) == (4, 3, 1, 1)


def test_unpivot(spark):
    df = spark.createDataFrame([(1, "Y", "N", None, "a")], "pr int, q_1 string, q_2 string, w_1 string, w_2 string")
    assert {tuple(r) for r in labels.unpivot_ratings(df, ["pr"], ["q", "w"]).collect()} == {(1, "q", "Y", "N"), (1, "w", None, "a")}
    assert labels.size_status(F.lit("x")) is not None


def test_last_line_break_opens_no_line(spark):
    df = spark.createDataFrame([("a", "x\nrun docker\n"), ("b", ""), ("c", "docker\n\n")], "source string, content string")
    assert sorted((r.source, r.line_no, r.content) for r in logs.number_lines(df).collect()) == [("a", 1, "x"), ("a", 2, "run docker"), ("c", 1, "docker"), ("c", 2, "")]
    assert sorted((r.source, r.line_no) for r in logs.context_in_text(df, radius=3).collect()) == [("a", 1), ("a", 2), ("c", 1), ("c", 2)]


def test_context_across_line_blocks(spark):
    lines = spark.range(1, 4000).select(F.lit("s").alias("source"), F.col("id").alias("line_no"), F.when(F.col("id").isin(1023, 1024, 3000), "docker").otherwise("x").alias("content"))
    for radius in (3, 1500):
        got = logs.context_in_lines(lines, radius=radius)
        want = sum(min(3999, m + radius) - max(1, m - radius) + 1 for m in (1023, 1024, 3000))
        assert got.count() == want
