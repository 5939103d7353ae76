from __future__ import annotations

import base64
import gzip
import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from drydock.llm import warc


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def brute(rows, least=0):
    best = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if page is not None and len(data) >= least:
            best[data] = max(best.get(data, page), page)
    out = []
    for page, url, html in rows:
        data = (html or "").encode()
        to = best.get(data)
        revisit = to is not None and page != to
        out.append((page, url or "", len(data), b32(data), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(6)
    same = ["<p>copy</p>", "", None, "<b>é日</b>" * 50]
    rows = [(rng.randrange(-(10**6), 10**12), f"http://h/{k}", rng.choice(same) if rng.random() < 0.5 else f"<p>{rng.random()}</p>" * rng.randrange(1, 200)) for k in range(300)]
    rows += [rows[0], rows[0], (None, None, "<p>copy</p>"), (None, "u", "only here"), (7, "http://a\r\nb", "x" * 400_000), (2**62, None, "far")]
    return rows


def run(spark, rows, folder, parts, **kw):
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, payload string, shard int")
    warc.write_archives(pages.repartition(parts), folder, shard_bytes=40_000, file_bytes=6_000, **kw)
    return warc.read_archives(spark, folder)


@pytest.mark.parametrize("least", [0, 20])
def test_round_trip(spark, tmp_path, least):
    rows = corpus()
    back = run(spark, rows, str(tmp_path / "a"), 4, least_bytes=least).collect()
    got = sorted(((r["page_id"], r["url"].replace("%0D%0A", "\r\n"), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back), key=str)
    assert got == brute(rows, least)
    full = {(page, (html or "").encode()) for page, _, html in rows}
    assert all((r["page_id"], bytes(r["payload"])) in full for r in back if r["record_type"] == "response")


def test_same_bytes_however_partitioned(spark, tmp_path):
    rows = corpus()
    for name, parts in (("a", 1), ("b", 7)):
        run(spark, rows, str(tmp_path / name), parts).count()
    files = [{p.name: p.read_bytes() for p in Path(tmp_path / n / "archive").iterdir() if not p.name.startswith(".")} for n in "ab"]
    assert files[0] == files[1] and len(files[0]) > 5
    manifest = spark.read.parquet(str(tmp_path / "a" / "manifest")).collect()
    assert {r["file"] for r in manifest} == set(files[0])
    assert sum(r["length"] for r in manifest) == sum(map(len, files[0].values()))
    assert sum(gzip.decompress(x).count(b"WARC/1.1\r\n") for x in files[0].values()) == len(rows)


def test_files_of_a_broken_run_are_not_read(spark, tmp_path):
    folder = tmp_path / "a"
    run(spark, [(1, "u", "one")], str(folder), 1)
    (folder / "archive" / "part-000009-00000.warc.gz").write_bytes(b"broken")
    (folder / "archive" / ".part-000000-00000.warc.gz.x.tmp").write_bytes(b"broken")
    assert [r["page_id"] for r in warc.read_archives(spark, str(folder)).collect()] == [1]


def test_wrong_digest_is_an_error():
    data = warc.record(3, "u", b"payload", None, False)
    assert warc.parse(data)[:3] == (3, "u", b"payload")
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r", b"pAyload\r"))


def test_empty_table(spark, tmp_path):
    assert run(spark, [], str(tmp_path / "a"), 1).count() == 0


def test_many_tasks_read(spark, tmp_path):
    rng = random.Random(5)
    pages = [(i, f"u{i}", "".join(rng.choice("abcdefgh") for _ in range(900))) for i in range(120)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    manifest = warc.write_archives(df, f"file://{tmp_path}/w", shard_bytes=3000)
    assert manifest.select("shard").distinct().count() > 30
    back = warc.read_archives(spark, f"file://{tmp_path}/w")
    assert back.select(F.spark_partition_id()).distinct().count() > 8
    assert {(r["page_id"], bytes(r["payload"]).decode()) for r in back.collect()} == {(i, t) for i, _, t in pages}
    sizes = df.select("page_id", F.length("html").cast("long").alias("size"))
    cuts = warc._cuts(sizes, 20_000)
    assert (cuts == [i for i in range(1, 120) if (900 * i) // 20_000 > (900 * (i - 1)) // 20_000]).all()
