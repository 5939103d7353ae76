"""How often rows move and files are opened, as far as plans tell."""

from __future__ import annotations

from pyspark.sql import functions as F

from drydock.operators import skew
from drydock.plans import frames
from drydock.sources import csvfiles, files


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_ordered_work_move_once(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("pos"), F.col("id").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (skew.running(rows, ["k"], ["pos"], "v"), skew.previous(rows, ["k"], ["pos"], "v", "b")):
            assert "SortMergeJoin" not in plan_of(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_split_is_dealt_out(spark):
    assert frames.spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == 4


def test_logs_are_opened_once(spark, tmp_path):
    for k in range(60):
        (tmp_path / f"{k}.log").write_text("a\nb\n")
    lines = files.read_log_lines(spark, str(tmp_path))
    assert len(lines.inputFiles()) < 60 and lines.count() == 120


def test_lines_of_records_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h,i\n1,"x\ny"\n2,z\n')
    records = csvfiles.read_records(spark, str(tmp_path))
    assert "Window" not in plan_of(records)
    assert sorted((r.pos, r.record) for r in records.collect()) == [(0, "h,i"), (1, '1,"x\ny"'), (2, "2,z")]
