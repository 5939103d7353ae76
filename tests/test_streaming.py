from __future__ import annotations

import datetime as dt
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from drydock.operators import containers
from drydock.sources import snapshots
from drydock.streaming import completions, transitions, watch


@pytest.fixture
def captures(spark):
    """Container snapshots in three files, so a stream can take them in three batches."""
    def doc(running, user):
        return json.dumps([{"State": {"Running": running}, "Config": {"User": user}, "HostConfig": {}, "NetworkSettings": {}}])

    rows = []
    for t in range(1, 7):
        for c in ("a", "b", "c"):
            rows.append((c, t, doc((t + len(c)) % 3 != 0, "root" if t % 2 else "app")))
    schema = "container_id string, t int, json string"
    return [spark.createDataFrame([r for r in rows if (r[1] - 1) // 2 == k], schema) for k in range(3)], schema


def write(parts, path):
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(f"{path}/{i}")


def stream(spark, path, schema):
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
    return snapshots.containers(reader.parquet(path), ("container_id", "t"))


def test_watch_equals_batch(spark, captures, tmp_path):
    parts, schema = captures
    write(parts, str(tmp_path / "in"))
    snaps = stream(spark, str(tmp_path / "in"), schema)
    watch.watch_containers(snaps, str(tmp_path / "out"), str(tmp_path / "cp"), ["container_id", "t"]).awaitTermination()
    batch = snapshots.containers(spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")), ("container_id", "t"))
    expected = containers.container_findings(batch, ["container_id", "t"])
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_transitions_over_batches_equal_one_batch(spark, captures, tmp_path):
    parts, schema = captures
    write(parts, str(tmp_path / "in"))
    sets = containers.rule_sets(stream(spark, str(tmp_path / "in"), schema), ["container_id", "t"])
    transitions.watch_transitions(sets, str(tmp_path / "out"), str(tmp_path / "cp"), "container_id", ["t"]).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("container_id", "t", "rule_id", "change")
    batch = snapshots.containers(spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")), ("container_id", "t"))
    expected = containers.transitions(containers.rule_sets(batch, ["container_id", "t"]), "container_id", ["t"])
    assert got.count() > 10
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_a_late_snapshot_changes_nothing(spark, tmp_path):
    schema = "s string, t int, rule_ids array<string>"
    batches = [[("a", 10, ["x"]), ("b", 1, ["y"])], [("a", 5, ["x", "y"])], [("a", 11, ["z"]), ("a", 10, ["q"])]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
    transitions.watch_transitions(reader.parquet(f"{tmp_path}/in"), str(tmp_path / "out"), str(tmp_path / "cp"), "s", ["t"]).awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("a", 10, "x", "opened"), ("b", 1, "y", "opened"), ("a", 11, "z", "opened"), ("a", 11, "x", "closed")}


def test_bad_interval(spark, captures, tmp_path):
    parts, schema = captures
    write(parts[:1], str(tmp_path / "in"))
    with pytest.raises(ValueError):
        watch.watch_containers(stream(spark, str(tmp_path / "in"), schema), str(tmp_path / "o"), str(tmp_path / "c"), ["t"], every_seconds=0)


def test_stream_equals_batch_with_repeats_and_open_ends(spark, tmp_path):
    words = [f"w{i} " for i in range(25)]
    rows = [("x", i, w, "stop" if i == 24 else None) for i, w in enumerate(words)] + [("y", 0, "only", "stop"), ("z", 0, "open", None)]
    schema = "id string, seq long, text string, finish_reason string"
    frames = [spark.createDataFrame(rows[i::3] + rows[:2], schema) for i in range(3)]
    write(frames, str(tmp_path / "in"))
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
    completions.watch_completions(reader.parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {tuple(r) for r in completions.latest(spark, str(tmp_path / "out")).collect()}
    assert got == {("x", "".join(words), 25, "stop"), ("y", "only", 1, "stop"), ("z", "open", 1, None)}
    assert got == {tuple(r) for r in completions.reassemble(spark.createDataFrame(rows + rows[:5], schema)).collect()}


def test_windowed_counts(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(minutes=m), "r") for m in (0, 30, 70)]
    df = spark.createDataFrame(rows, "ts timestamp, rule_id string")
    assert sorted(r.n for r in watch.finding_counts(df, "ts").collect()) == [1, 2]


def in_order(spark, path, batches, schema):
    """A stream with one micro-batch for each list of rows; times are minutes."""
    for rows in batches:
        df = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds(F.col("m") * 60 + START)).drop("m")
        df.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


START = 1_704_067_200
CHUNKS = "id string, seq long, text string, finish_reason string, m double"


def test_completions_close_once(spark, tmp_path):
    batches = [
        [("a", 0, "a0 ", None, 0.0), ("a", 1, "a1", "stop", 0.1), ("b", 1, "b1", "stop", 0.2), ("silent", 0, "s0", None, 0.3), ("gap", 0, "g0", "length", 0.0)],
        [("b", 0, "b0 ", None, 0.1), ("a", 2, "after its end", None, 0.5), ("a", 1, "a1", "stop", 0.1), ("x", 0, "x", None, 20.0)],
        [("silent", 1, "far too late", "stop", 0.4), ("x", 1, "!", None, 21.0), ("y", 0, "y0", None, 40.0)],
        [("a", 0, "again", "stop", 41.0), ("x", 2, "new", None, 41.0), ("y", 1, "y1", None, 45.5), ("z", 0, "z", "stop", 46.0), ("open", 0, "o", None, 47.0)],
    ]
    chunks = in_order(spark, f"{tmp_path}/in", batches, CHUNKS)
    query = completions.watch_closing(chunks, f"{tmp_path}/out", f"{tmp_path}/cp", "ts", "2 minutes", "5 minutes")
    query.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()))
    assert got == sorted(
        [
            ("a", "a0 a1", 2, "stop", "finish"),
            ("b", "b0 b1", 2, "stop", "finish"),
            ("gap", "g0", 1, "length", "finish"),
            ("silent", "s0", 1, None, "timeout"),
            ("x", "x!", 2, None, "timeout"),
            ("a", "again", 1, "stop", "finish"),
            ("z", "z", 1, "stop", "finish"),
        ]
    )
    held = spark.read.format("statestore").option("stateVarName", "chunks").load(f"{tmp_path}/cp")
    assert {r["key"]["id"] for r in held.select("key").collect()} == {"x", "y", "open"}
    rows = [r for batch in batches for r in batch if r[2] != "far too late"]
    whole = spark.createDataFrame(rows, CHUNKS).withColumn("ts", F.timestamp_seconds(F.col("m") * 60 + START))
    assert sorted(map(tuple, completions.close_completions(whole, "ts", "2 minutes", "5 minutes").collect())) == got


def test_closing_in_batches_equals_whole(spark, tmp_path):
    rng = random.Random(1)
    rows = []
    for k in range(60):
        start, n = rng.uniform(0, 100), rng.randrange(1, 6)
        for seq in range(n):
            if rng.random() < 0.9:
                rows.append((f"id{k % 25}-{k // 50}", seq, f"{k}.{seq} ", "stop" if seq == n - 1 and rng.random() < 0.7 else None, round(start + seq * 0.1, 3)))
    used, unique = set(), []
    for r in rows:  # one completion an id
        if (r[0], r[1]) not in used:
            used.add((r[0], r[1]))
            unique.append(r)
    unique.sort(key=lambda r: r[4] + rng.uniform(0, 1))
    batches = [unique[len(unique) * k // 4 : len(unique) * (k + 1) // 4] for k in range(4)]
    chunks = in_order(spark, f"{tmp_path}/in", batches, CHUNKS)
    completions.watch_closing(chunks, f"{tmp_path}/out", f"{tmp_path}/cp", "ts", "3 minutes", "3 minutes").awaitTermination()
    whole = spark.createDataFrame(unique, CHUNKS).withColumn("ts", F.timestamp_seconds(F.col("m") * 60 + START))
    want = completions.close_completions(whole, "ts", "3 minutes", "3 minutes")
    assert want.count() > 10
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == sorted(map(tuple, want.collect()))


def test_subjects_that_vanish(spark, tmp_path):
    schema = "s string, rule_ids array<string>, m double"
    batches = [
        [("a", ["x"], 0.0), ("b", ["y", "z"], 1.0), ("c", [], 1.0)],
        [("a", ["x", "w"], 5.0), ("c", ["v"], 6.0), ("d", ["q"], 20.0)],
        [("b", ["y"], 21.0), ("a", ["late"], 2.0), ("d", ["q"], 40.0)],
        [("a", ["x"], 41.0), ("e", ["t"], 60.0)],
    ]
    sets = in_order(spark, f"{tmp_path}/in", batches, schema)
    query = transitions.watch_expiring(sets, f"{tmp_path}/out", f"{tmp_path}/cp", "s", "ts", ["ts"], "10 minutes", "2 minutes")
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").withColumn("m", (F.unix_seconds("at") - START) / 60).select("s", "m", "rule_id", "change")
    got = sorted(map(tuple, got.collect()))
    assert got == sorted(
        [
            ("a", 0.0, "x", "opened"), ("a", 5.0, "w", "opened"), ("a", 15.0, "x", "closed"), ("a", 15.0, "w", "closed"),
            ("a", 41.0, "x", "opened"), ("a", 51.0, "x", "closed"),
            ("b", 1.0, "y", "opened"), ("b", 1.0, "z", "opened"), ("b", 11.0, "y", "closed"), ("b", 11.0, "z", "closed"),
            ("b", 21.0, "y", "opened"), ("b", 31.0, "y", "closed"),
            ("c", 6.0, "v", "opened"), ("c", 16.0, "v", "closed"),
            ("d", 20.0, "q", "opened"), ("d", 30.0, "q", "closed"), ("d", 40.0, "q", "opened"), ("d", 50.0, "q", "closed"),
            ("e", 60.0, "t", "opened"),
        ]
    )
    held = spark.read.format("statestore").option("stateVarName", "last").load(f"{tmp_path}/cp")
    assert [r["key"]["s"] for r in held.select("key").collect()] == ["e"]
    rows = [r for batch in batches for r in batch if r[1] != ["late"]]
    whole = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds(F.col("m") * 60 + START))
    batch = containers.transitions_with_expiry(whole, "s", "ts", ["ts"], "10 minutes", "2 minutes")
    assert sorted(map(tuple, batch.withColumn("m", (F.unix_seconds("at") - START) / 60).select("s", "m", "rule_id", "change").collect())) == got


def test_counts_of_windows_over_batches(spark, tmp_path):
    schema = "event int, rule_id string, m double"
    batches = [
        [(1, "r", 0.0), (2, "r", 30.0), (2, "r", 30.0), (3, "q", 50.0)],
        [(4, "r", 58.0), (2, "r", 30.0), (5, "r", 70.0)],
        [(6, "r", 5.0), (7, "r", 200.0)],
        [(8, "r", 210.0)],
    ]
    found = in_order(spark, f"{tmp_path}/in", batches, schema)
    watch.watch_counts(found, f"{tmp_path}/out", f"{tmp_path}/cp", "ts", "1 hour", "30 minutes", ["event", "rule_id"]).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").select((F.unix_seconds("window_start") - START) / 3600, "rule_id", "n")
    assert sorted(map(tuple, got.collect())) == [(0.0, "q", 1), (0.0, "r", 3), (1.0, "r", 1)]


def test_chunks_and_snapshots_without_time_or_id_do_not_break_a_stream(spark, tmp_path):
    schema = "id long, seq long, text string, finish_reason string, m double"
    rows = [(1, 0, "a", "stop", 0.0), (1, 1, "x", None, None), (None, 0, "n", "stop", 0.0), (2, 0, "b", "stop", 1.0)]
    chunks = in_order(spark, f"{tmp_path}/in", [rows], schema)
    completions.watch_closing(chunks, f"{tmp_path}/out", f"{tmp_path}/cp", "ts", "2 minutes", "5 minutes").awaitTermination()
    got = {(r.id, r.text) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {(1, "a"), (None, "n"), (2, "b")}
    sets = [[("a", 1, ["x"], 0.0), ("a", None, ["y"], 1.0), (None, 2, ["z"], 1.0), ("b", 1, ["x"], None)]]
    seen = in_order(spark, f"{tmp_path}/in2", sets, "s string, n long, rule_ids array<string>, m double")
    transitions.watch_expiring(seen, f"{tmp_path}/out2", f"{tmp_path}/cp2", "s", "ts", ["ts", "n"], "10 minutes", "2 minutes").awaitTermination()
    got = {(r.s, r.rule_id, r.change) for r in spark.read.parquet(f"{tmp_path}/out2").collect()}
    assert got == {("a", "x", "opened"), ("a", "x", "closed"), ("a", "y", "opened"), (None, "z", "opened")}
