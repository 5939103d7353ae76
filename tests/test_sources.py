from __future__ import annotations

import json

from pyspark.sql import functions as F

from drydock.functions import paths
from drydock.operators import lint, mining
from drydock.sources import files, repos, schemas, sheets, sinks, snapshots


def test_repo_lists(spark, tmp_path):
    p = tmp_path / "repos.txt"
    p.write_text("# head\n\n  https://x/a/r1.git  \nname, https://x/a/r2 , http://x/b\nhttps://x/a/r3,https://x/a/r4/\n  # c\n")
    lines = repos.numbered_lines(spark, str(p))
    urls = [r.url for r in repos.repo_urls(lines).orderBy("line_no", "part").collect()]
    assert urls == ["https://x/a/r1.git", "https://x/a/r2", "http://x/b", "https://x/a/r3", "https://x/a/r4/"]
    plain = [r.url for r in repos.plain_repo_urls(lines).orderBy("line_no").collect()]
    assert plain == ["https://x/a/r1.git", "name, https://x/a/r2 , http://x/b", "https://x/a/r3,https://x/a/r4/", "# c"]
    assert repos.first_repo_url(lines).first().url == "https://x/a/r1.git"


def test_repo_names(spark):
    urls = ["https://x/a/r.git", "https://x/a/r/", "https://x/a/r/tree/master"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(paths.repo_name(F.col("u"))).collect()] == ["r", "r", "r"]
    assert df.select(paths.repo_name(F.col("u"), tree_aware=False)).collect()[2][0] == "master"


def test_repo_sheets(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text('Repository,Repo,note\nu1,v1,"a\nb"\n,v2,\n,,x\nu4,,\n')
    assert [r.url for r in repos.read_repo_sheet(spark, str(p)).collect()] == ["u1", "v2", "u4"]
    assert [r.url for r in repos.read_repo_sheet(spark, str(p), limit=2).collect()] == ["u1", "v2"]
    c = tmp_path / "c.csv"
    c.write_text("Id,Repo,Uses Docker ?,Is CPS related/specific\nDrones,,,\n1,u1,Yes,Yes\n2,u2,Yes,No\n3,u3,yes,Yes\n")
    rows = repos.classified_repos(spark.read.csv(str(c), header=True))
    assert rows.count() == 3 and [r.repo for r in mining.relevant_repos(rows).collect()] == ["u1"]


def test_build_files(spark, tmp_path):
    for name, body in {"a/Dockerfile": b"FROM x\xff\n", "a/b/dockerfile.gpu": b"no", "a/Dockerfile-x": b"", "README": b"log\xff"}.items():
        f = tmp_path / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(body)
    rows = {r.file_name: r for r in files.read_build_files(spark, str(tmp_path)).collect()}
    assert set(rows) == {"Dockerfile", "dockerfile.gpu"}
    assert rows["Dockerfile"].content == "FROM x�\n" and rows["Dockerfile"].is_plausible and not rows["dockerfile.gpu"].is_plausible
    assert files.read_logs(spark, str(tmp_path / "README")).first().content == "log\ufffd"


def test_json_lines_drop_malformed(spark, tmp_path):
    p = tmp_path / "l.jsonl"
    p.write_text('{"ID":"1","State":"running"}\n\n{bad\n{"ID":"2","State":"exited"}\n')
    assert snapshots.read_json_lines(spark, str(p), schemas.CONTAINER_LISTING).count() == 2
    lines = spark.read.text(str(p)).withColumnRenamed("value", "line")
    assert [r.ID for r in snapshots.container_listing(lines).collect()] == ["1"]
    assert snapshots.container_listing(lines, all_containers=True).count() == 2
    images = spark.createDataFrame([('{"ID":"1","Repository":"","Tag":"t"}',)], "line string")
    assert snapshots.image_listing(images).first().name == "<none>:t"


def test_history(spark):
    text = "\n".join(json.dumps({"ID": i, "Size": s}) for i, s in (("top", "1 MB"), ("base", "2 MB")))
    df = spark.createDataFrame([("i", text + "\n")], "image_id string, lines string")
    rows = sorted((r.pos, r.ID) for r in snapshots.history(df).collect())
    assert rows == [(0, "base"), (1, "top")]
    broken = df.selectExpr("image_id", "concat('{\"ID\":\\n\\n', lines, '\\n') as lines")
    assert sorted((r.pos, r.ID) for r in snapshots.history(broken).collect()) == rows


def test_build_files_of_zero_bytes_are_read(spark, tmp_path):
    for name, text in (("a/Dockerfile", ""), ("a b/dockerfile.x", "FROM a"), ("c/Dockerfile.é y", ""), ("c/other", ""), ("d/Dockerfile", "\n")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    got = sorted((r.path.split(f"{tmp_path}/")[1], r.content, r.is_plausible) for r in files.read_build_files(spark, str(tmp_path)).collect())
    assert got == [("a b/dockerfile.x", "FROM a", True), ("a/Dockerfile", "", False), ("c/Dockerfile.é y", "", False), ("d/Dockerfile", "\n", False)]


def test_completion_chunks(spark):
    lines = ['data: {"id":"c","created":1,"choices":[{"text":"a","index":0,"finish_reason":null}]}', "", "data: [DONE]", "event: x"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert [tuple(r) for r in snapshots.completion_chunks(df).collect()] == [("c", 1, "a", None)]


def test_pull_requests(spark, tmp_path):
    p = tmp_path / "p.csv"
    p.write_text(
        "Project,PNumber,CreatedAt,ClosedAt,isMerged,MergedAt,MergedCommit,nFiles,nCommits,Commits,Labels,Title,Body\n"
        'a/b,1,2020-01-02T03:04:05Z,2020-01-03T00:00:00Z,TRUE,none,x,2,1,c1 c2,,"t, u","line\nline"\n'
        "a/b,2,2020-01-02T03:04:05Z,2020-01-03T00:00:00Z,False,2020-01-04T00:00:00Z,x,0,1,,,t,b\n"
    )
    rows = sheets.read_pull_requests(spark, str(p)).orderBy("pos").collect()
    assert [(r.pnumber, r.is_merged, r.merged_at is None, r.commits, r.title) for r in rows] == [
        (1, True, True, ["c1", "c2"], "t, u"), (2, False, False, None if rows[1].commits is None else [], "t"),
    ]
    assert rows[0].body == "line\nline" and rows[0].created_at.year == 2020


def test_sheets(spark, tmp_path):
    (tmp_path / "proj_Patterns.csv").write_text("ci/\n\n tests \n")
    assert {tuple(r) for r in sheets.read_patterns(spark, str(tmp_path / "proj_Patterns.csv")).collect()} == {("proj", "ci/"), ("proj", "tests")}
    (tmp_path / "t.csv").write_text("Name;Frequency;Is New?\nA_b;3;YES\n")
    r = sheets.read_taxonomy(spark, str(tmp_path / "t.csv"), "bad").first()
    assert (r.label, r["levels"], r.freq, r.is_new) == ("A_b", ["A", "b"], 3, "YES")
    (tmp_path / "r.csv").write_text("L;R;Occurrences\na;x;1\n;y;2\n")
    assert [tuple(r) for r in sheets.read_relations(spark, str(tmp_path / "r.csv")).collect()] == [(1, "a", "x", 1), (2, "", "y", 2)]
    head = ";".join(["Project", "Pull"] + [f"c{i}" for i in range(12)])
    (tmp_path / "a.csv").write_text(f"{head}\np;7;{';'.join('ab' * 6)}\n")
    r = sheets.read_annotations(spark, str(tmp_path / "a.csv")).first()
    assert (r.project, r.is_challenge_1, r.restructuring_2) == ("p", "a", "b")
    (tmp_path / "s.csv").write_text("Repo,a,b,c,\n#x,1GB,N/A,2 GB,\n")
    assert tuple(sheets.read_observed_sizes(spark, str(tmp_path / "s.csv")).first()) == ("#x", "1GB", "N/A", "2 GB")


def test_commits(spark):
    rows = [("https://h/o/r", "s1", "a/Dockerfile", "MODIFY"), ("https://h/o/r", "s1", "b.docker", "DELETE"), ("https://h/o/r", "s2", "Dockerfile", "ADD"), ("https://h/o/q", "s3", "x.yml", "MODIFY")]
    df = spark.createDataFrame(rows, "repo_url string, sha string, filename string, change_type string")
    urls = mining.container_commits(df)
    assert [r.commit_url for r in urls.collect()] == ["https://github.com/o/r/commit/s1"]
    assert tuple(mining.split_commit_urls(urls).first())[1:] == ("o", "r", "s1")
    assert mining.container_commits(df, path_test="container_and_deploy_files").count() == 2
    only = spark.createDataFrame([("https://h/o/zz",)], "repo_url string")
    assert mining.container_commits(df, only).count() == 0
    lines = spark.createDataFrame([(" u ",), ("",)], "line string")
    assert [r.commit_url for r in repos.commit_urls(lines).collect()] == ["u"]


def test_search_pages(spark):
    page = {"items": [{"html_url": "u", "stargazers_count": 10, "fork": False}, {"html_url": "v", "stargazers_count": 9, "fork": False}, {"html_url": "w", "stargazers_count": 99, "fork": True}]}
    df = spark.createDataFrame([("a", json.dumps(page)), ("b", json.dumps(page)), ("c", "{}")], "topic string, json string")
    assert [r.repo_url for r in mining.search_hits(snapshots.search_pages(df)).collect()] == ["u"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", None), ("a", 'x,"y')], "k string, v string")
    sinks.write_results(df, str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True, escape='"')
    assert {tuple(r) for r in back.collect()} == {("b", None), ("a", 'x,"y')}
    sinks.write_sorted_lines(df, "k", str(tmp_path / "txt"))
    assert [r.value for r in spark.read.text(str(tmp_path / "txt")).collect()] == ["a", "b"]
    sinks.write_json(df.select(F.struct("k").alias("s")), str(tmp_path / "json"))
    assert {r.s.k for r in spark.read.json(str(tmp_path / "json")).collect()} == {"a", "b"}
    sinks.write_stage_texts(df.withColumn("stage", F.col("k")), str(tmp_path / "st"))
    assert spark.read.parquet(str(tmp_path / "st")).filter("stage = 'a'").count() == 1
    sinks.write_scorecard(df, lambda saved: saved.limit(1), str(tmp_path / "card"), fmt="csv")
    assert spark.read.csv(str(tmp_path / "card" / "scores"), header=True).count() == 2
    sinks.write_rows(df, str(tmp_path / "rows"))


def test_rule_table(spark):
    table = lint.rule_table(spark)
    assert table.count() == table.select("rule_id").distinct().count()


def test_log_lines_are_numbered_over_splits(spark, tmp_path):
    texts = {"a.log": "".join(f"line {i}\n" for i in range(5000)), "b.log": "x\r\n\ny\x0bz", "c.log": ""}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        got = {}
        for r in files.read_log_lines(spark, str(tmp_path)).collect():
            got.setdefault(r.source.rsplit("/", 1)[1], []).append((r.line_no, r.content))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert {k: [c for _, c in sorted(v)] for k, v in got.items()} == {k: t.splitlines() for k, t in texts.items() if t}
    assert all([n for n, _ in sorted(v)] == list(range(1, len(v) + 1)) for v in got.values())
