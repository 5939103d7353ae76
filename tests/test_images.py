from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from drydock.functions import sizes
from drydock.operators import containers, images
from drydock.sources import snapshots

MB = 1024 * 1024


def image_doc(**over):
    config = {"User": "app", "Healthcheck": {"Test": ["CMD"]}, "Env": ["PIP_NO_CACHE_DIR=1"], "Cmd": ["x"]} | over.pop("Config", {})
    return {"Size": 10, "RootFS": {"Layers": ["sha256:a"]}, "Config": config} | over


def image_rules(spark, doc, layers=None):
    raw = doc if isinstance(doc, str) else json.dumps([doc])
    frame = snapshots.images(spark.createDataFrame([("i", raw)], "image_id string, json string"))
    if layers is not None:
        layers = spark.createDataFrame([("i", s) for s in layers], "image_id string, size_text string")
    return {(r.rule_id, r.n) for r in images.image_findings(frame, layers).collect()}


@pytest.mark.parametrize(
    ("over", "expected"),
    [
        ({}, "image_ok"),
        ({"Size": 500 * MB}, "image_ok"),
        ({"Size": 500 * MB + 1}, "image_size"),
        ({"RootFS": {"Layers": ["l"] * 21}}, "image_layers"),
        ({"Config": {"User": ""}}, "image_root"),
        ({"Config": {"User": None}}, "image_root"),
        ({"Config": {"Healthcheck": None}}, "image_no_healthcheck"),
        ({"Config": {"ExposedPorts": {"80/tcp": {}}}}, "image_ports_unlabelled"),
        ({"Config": {"ExposedPorts": {"80/tcp": {}}, "Labels": None}}, "image_ports_unlabelled"),
        ({"Config": {"ExposedPorts": {"80/tcp": {}}, "Labels": {"org.opencontainers.image.source": "u"}}}, "image_ok"),
        ({"Config": {"Cmd": ["/usr/bin/Python3"]}}, "image_python_buffered"),
        ({"Config": {"Cmd": ["python"], "Env": ["PIP_NO_CACHE_DIR=true", "PYTHONUNBUFFERED=1"]}}, "image_ok"),
        ({"Config": {"Env": ["PIP_NO_CACHE_DIR=1", "PIP_NO_CACHE_DIR=0"]}}, "image_pip_cache"),
        ({"Config": {"Env": None}}, "image_pip_cache"),
    ],
)
def test_image_rules(spark, over, expected):
    assert image_rules(spark, image_doc(**over)) == {(expected, 1)}


def test_broken_documents(spark):
    assert image_rules(spark, "[]") == image_rules(spark, "[{") == {("image_inspect_failed", 1)}


def test_large_layers_count(spark):
    sizes_ = ["0B", "0 B", "", "201MB", "200 MB", "1.2GB", "900 kB", "1 GB", "x"]
    assert image_rules(spark, image_doc(), sizes_) == {("image_large_layer", 3)}
    layers = spark.createDataFrame([("i", s) for s in sizes_], "image_id string, size_text string")
    assert [r.size_text for r in images.large_layers(layers, strict=True).collect()] == ["1 GB"]


def test_env_map(spark):
    df = spark.createDataFrame([(["A=1", "B", "A=2=3", "=x"],)], "e array<string>")
    assert df.select(images.env_map(F.col("e"))).first()[0] == {"A": "2=3", "": "x"}


@pytest.mark.parametrize(
    ("n", "compact", "spaced", "signed"),
    [
        (0, "0B", "0.0 B", "0 B"),
        (1023, "1023B", "1023.0 B", "1023 B"),
        (1024, "1.00KB", "1.0 KB", "1.00 KB"),
        (1536, "1.50KB", "1.5 KB", "1.50 KB"),
        (1280, "1.25KB", "1.2 KB", "1.25 KB"),
        (1152, "1.12KB", "1.1 KB", "1.13 KB"),
        (10 * 1024 + 51, "10.05KB", "10.0 KB", "10.0 KB"),
        (100 * MB + MB // 2, "100.50MB", "100.5 MB", "101 MB"),
        (MB - 1, "1024.00KB", "1024.0 KB", "1024 KB"),
        (5 * 1024 * MB, "5.00GB", "5.0 GB", "5.00 GB"),
        (3 * 1024**5, "3072.00TB", "3.0 PB", "3.00 PB"),
    ],
)
def test_size_texts(spark, n, compact, spaced, signed):
    df = spark.createDataFrame([(n,)], "n long")
    got = df.select(sizes.compact_size(F.col("n")), sizes.spaced_size(F.col("n")), sizes.signed_size(F.col("n"))).first()
    assert tuple(got) == (compact, spaced, signed)


def test_signed_sizes(spark):
    df = spark.createDataFrame([(-1536,), (None,), (-5,)], "n long")
    assert [r[0] for r in df.select(sizes.signed_size(F.col("n"))).collect()] == ["-1.50 KB", "0 B", "-5 B"]


def test_layer_table(spark):
    rows = [("i", 1, None, "RUN  a\n b", "c", 5), ("i", 2, "sha256:0123456789abcdef", None, "", None), ("i", 3, "", "x" * 90, None, 7)]
    df = spark.createDataFrame(rows, "image_id string, pos int, layer_id string, created_by string, comment string, size_bytes long")
    out = images.layer_table(df, ["pos"]).orderBy("layer_no").collect()
    assert [(r.layer_no, r.layer, r.cumulative_bytes) for r in out] == [(1, "<unknown>", 5), (2, "0123456789ab", 5), (3, "<missing>", 12)]
    assert [r.command for r in out] == ["RUN a b (c)", "<metadata>", "x" * 79 + "…"]


def test_digests_go_to_sized_entries(spark):
    df = spark.createDataFrame([([("a", 0), ("b", 5), ("c", 0), ("d", 6)], ["L1", "L2"])], "h array<struct<layer_id:string,size_bytes:long>>, d array<string>")
    out = df.select(images.match_layers(F.col("h"), F.col("d")), images.match_layers(F.col("h"), F.col("d"), by_position=True)).first()
    assert [e.digest for e in out[0]] == [None, "L1", None, "L2"]
    assert [e.digest for e in out[1]] == ["L1", "L2", None, None]


OK_CONTAINER = {
    "State": {"Running": True},
    "Config": {"User": "app"},
    "HostConfig": {"RestartPolicy": {"Name": "always"}, "Memory": 5, "LogConfig": {"Type": "syslog"}},
    "NetworkSettings": {"Ports": {"80/tcp": [{"HostIp": "", "HostPort": "80"}]}},
}


@pytest.mark.parametrize(
    ("over", "expected"),
    [
        ({}, {"container_ok"}),
        ({"State": {"Running": False, "Health": {"Status": "bad"}}}, {"container_stopped"}),
        ({"State": {"Running": True, "Health": {"Status": "starting"}}}, {"container_unhealthy"}),
        ({"State": {"Running": True, "Health": {"Status": "healthy"}}}, {"container_ok"}),
        ({"Config": {}}, {"container_root"}),
        ({"HostConfig": {"RestartPolicy": None, "Memory": 5}}, {"container_no_restart"}),
        ({"HostConfig": {"RestartPolicy": {"Name": "always"}, "Memory": 0, "Privileged": True}}, {"container_no_memory_limit", "container_privileged"}),
        ({"HostConfig": {"RestartPolicy": {"Name": "no"}, "Memory": 1, "LogConfig": {"Type": ""}}}, {"container_no_restart", "container_log_driver"}),
        ({"NetworkSettings": {"Ports": {"80/tcp": None, "81/tcp": []}}}, {"container_port_unbound"}),
        ({"NetworkSettings": {"Ports": {}}}, {"container_ok"}),
    ],
)
def test_container_rules(spark, over, expected):
    df = spark.createDataFrame([("c", json.dumps([OK_CONTAINER | over]))], "container_id string, json string")
    assert {r.rule_id for r in containers.container_findings(snapshots.containers(df)).collect()} == expected


def test_transitions(spark):
    rows = [("a", 1, ["x", "y"]), ("a", 2, ["y", "z"]), ("a", 9, ["y", "z"]), ("b", 5, []), ("a", 20, [])]
    df = spark.createDataFrame(rows, "s string, t int, rule_ids array<string>")
    got = {tuple(r) for r in containers.transitions(df, "s", ["t"]).collect()}
    assert got == {
        ("a", 1, "x", "opened"), ("a", 1, "y", "opened"), ("a", 2, "z", "opened"), ("a", 2, "x", "closed"),
        ("a", 20, "y", "closed"), ("a", 20, "z", "closed"),
    }


def test_image_summary(spark):
    doc = image_doc(Config={"User": "", "WorkingDir": "", "Env": [f"E{i}=1" for i in range(12)], "Labels": {f"l{i}": "v" for i in range(11)}, "Cmd": ["a", "b"]})
    frame = snapshots.images(spark.createDataFrame([("i", json.dumps([doc]))], "image_id string, json string"))
    r = images.image_summary(frame).first()
    assert (r.user, r.working_dir, r.cmd, r.repo_tags, len(r.env), len(r.labels), r.more_labels) == ("root", "/", "a, b", "<none>", 10, 10, True)
