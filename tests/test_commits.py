from __future__ import annotations

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from drydock.operators import ledger, replies, rows, skew
from drydock.sources import commits, csvfiles, files, sinks


def test_tables_change_together(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1,)], "k int")
    assert commits.read(spark, path, "a", "k int").count() == 0
    commits.commit(spark, path, replace={"a": commits.write_segment(one, path, "a"), "b": commits.write_segment(one, path, "b")})
    broken = commits.write_segment(one.withColumn("k", F.lit(9)), path, "a")  # the run ends before its commit
    assert [r.k for r in commits.read(spark, path, "a", "k int").collect()] == [1]
    two = one.withColumn("k", F.lit(2))
    commits.commit(spark, path, append={"a": commits.write_segment(two, path, "a")}, replace={"b": commits.write_segment(two, path, "b")})
    assert sorted(r.k for r in commits.read(spark, path, "a", "k int").collect()) == [1, 2]
    assert [r.k for r in commits.read(spark, path, "b", "k int").collect()] == [2]
    commits.sweep(spark, path, keep=1)
    assert not os.path.exists(f"{path}/{broken}") and sorted(r.k for r in commits.read(spark, path, "a", "k int").collect()) == [1, 2]
    assert len(os.listdir(f"{path}/b")) == 1


def test_a_broken_scorecard_run_leaves_the_old_pair(spark, tmp_path):
    path, card = str(tmp_path / "card"), spark.createDataFrame([("a", 1.0)], "k string, score double")
    sinks.write_scorecard(card, lambda s: s.agg(F.count("*").alias("n")), path)

    def fails(saved):
        raise RuntimeError("the run breaks between the two tables")

    with pytest.raises(RuntimeError):
        sinks.write_scorecard(card.unionByName(card), fails, path)
    scores, meta = sinks.read_scorecard(spark, path)
    assert scores.count() == 1 and meta.first().n == 1


def test_a_repeated_run_does_its_work_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "SEGMENTS", 2)
    path, keys = str(tmp_path / "l"), ["repo", "n"]
    work = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, 3), ("a", 1)], "repo string, n int")
    assert ledger.pending(work, path, keys).count() == 5
    first = work.filter("repo = 'a'")
    commits.write_segment(first, path, ledger.RESULTS)  # killed before the commit
    assert ledger.pending(work, path, keys).count() == 5
    ledger.finish(ledger.pending(first, path, keys).distinct(), path, keys)
    ledger.finish(ledger.pending(first, path, keys).distinct(), path, keys)  # repeated
    assert sorted(map(str, ledger.pending(work, path, keys).collect())) == sorted(map(str, work.filter("repo is null or repo = 'b'").collect()))
    ledger.finish(ledger.pending(work, path, keys), path, keys)
    assert ledger.pending(work, path, keys).count() == 0
    assert commits.read(spark, path, ledger.KEYS, "repo string, n int").count() == 4
    assert commits.read(spark, path, ledger.RESULTS, "repo string, n int").count() == 4
    assert len(commits.segments(spark, path)[ledger.KEYS]) == 1  # merged


def test_bitmap_keeps_every_key(spark):
    left, right = spark.range(100_000).withColumnRenamed("id", "k"), spark.range(0, 100_000, 997).withColumnRenamed("id", "k")
    near = rows.maybe_in(left, ["k"], right)
    assert near.join(right, "k").count() == right.count() and near.count() < 20_000
    assert rows.maybe_in(left, ["k"], right.limit(0)).count() == 0


def test_prompts_are_asked_once(spark, tmp_path):
    calls, path = str(tmp_path / "calls"), str(tmp_path / "answers")
    os.mkdir(calls)

    def complete(prompt):
        n = len(os.listdir(calls))
        with open(f"{calls}/{n}-{os.getpid()}-{prompt}", "w"):
            pass
        tried = sum(name.endswith(f"-{prompt}") for name in os.listdir(calls))
        if prompt == "slow" and tried < 3:
            raise TimeoutError("wait")
        if prompt == "bad" and tried < 2:
            raise ValueError("no")
        return f"answer to {prompt}"

    def asked(name):
        return sum(x.endswith(f"-{name}") for x in os.listdir(calls))

    prompts = spark.createDataFrame([(1, "p"), (2, "p"), (3, "slow"), (4, "bad"), (5, "p")], "file_id int, prompt string")
    got = {tuple(r) for r in replies.ask_once(prompts, complete, path, pause=0.01, callers=1).collect()}
    assert got == {(1, "answer to p"), (2, "answer to p"), (5, "answer to p"), (3, "answer to slow"), (4, "LLM API error: no")}
    assert (asked("p"), asked("slow"), asked("bad")) == (1, 3, 1)
    got = {tuple(r) for r in replies.ask_once(prompts, complete, path, pause=0.01, callers=1).collect()}
    assert (4, "answer to bad") in got and (asked("p"), asked("slow"), asked("bad")) == (1, 3, 2)
    replies.ask_once(prompts, complete, path, callers=1).collect()
    assert (asked("p"), asked("slow"), asked("bad")) == (1, 3, 2)


@pytest.mark.parametrize("block", [1_000_000, 7])
def test_quantiles_equal_percentile(spark, block):
    rng = random.Random(2)
    shares = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.333, "e": 1.0}
    for values in ([], [None], [3.5], [1.0] * 50 + [2.0], [rng.gauss(0, 5) for _ in range(501)] + [None] * 9, [float(i % 4) for i in range(200)]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        want = df.agg(*[F.percentile("v", s).alias(n) for n, s in shares.items()]).first()
        assert tuple(skew.quantiles(df, "v", shares, block).first()) == tuple(want)


def test_csv_records_over_splits(spark, tmp_path):
    rng = random.Random(0)
    for k in range(3):
        with open(tmp_path / f"f{k}.csv", "w", newline="") as f:
            w = csv.writer(f, lineterminator="\r\n" if k == 1 else "\n")
            w.writerow(["a", 'b "x"', "c"])
            for i in range(300):
                long = 3000 if rng.random() < 0.02 else 9
                w.writerow([i, "".join(rng.choice('ab",\n x') for _ in range(rng.choice([0, 5, 20, long]))), rng.choice(["", "z", "\n\n", "é"])])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        schema = "a int, b string, c string"
        got = csvfiles.read_csv(spark, str(tmp_path), schema)
        assert spark.read.text(str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 5
        want = spark.read.csv(str(tmp_path), schema=schema, header=True, multiLine=True, escape='"')
        assert sorted(map(str, got.drop("pos").collect())) == sorted(map(str, want.collect()))
        one = csvfiles.read_csv(spark, str(tmp_path / "f0.csv"), schema).orderBy("pos")
        assert [r.a for r in one.collect()] == list(range(300))
        assert csvfiles.header_of(spark, str(tmp_path)) == ["a", 'b "x"', "c"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_tasks_list_a_tree(spark, tmp_path):
    want = {}
    for k in range(40):
        folder = tmp_path / f"d{k % 7}" / f"e{k % 3}" / "sub dir"
        folder.mkdir(parents=True, exist_ok=True)
        name = ["Dockerfile", "Dockerfile.dev", "main.c", "dockerfile"][k % 4] + ("" if k % 4 else f".{k}")
        (folder / name).write_text("FROM a\n" * (k % 5))
        want[str(folder / name)] = 7 * (k % 5)
    os.symlink(tmp_path, tmp_path / "d0" / "loop")
    for entries in (10_000, 3):
        got = {r.path.removeprefix("file:"): r.size for r in files.list_files(spark, str(tmp_path), entries).collect()}
        assert got == {p: os.path.getsize(p) for p in want}
    read = files.read_build_files(spark, f"file://{tmp_path}").collect()
    assert {r.path.removeprefix("file:") for r in read} == {p for p in want if not p.endswith("main.c")}
    assert {r.path.removeprefix("file:"): len(r.content) for r in read} == {p: os.path.getsize(p) for p in want if not p.endswith("main.c")}
