"""Input frames over the benchmark tables.

The benchmark tables are generic, so each frame maps one of them, whole, to the shape an operator
reads: a document becomes a build file, a part an image, a line item a layer or a diff, an event a
container snapshot, a conversation turn a model reply. Every mapping is a projection; none groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import hold
from ..sources import snapshots

# Line templates of the derived build files: text before and after a fragment of the document.
LINE_TEMPLATES = (
    ("RUN apt-get update && apt-get install -y ", ""),
    ("RUN apt-get install ", ""),
    ("RUN apt-get update ", ""),
    ("RUN pip install ", ""),
    ("RUN pip install --no-cache-dir ", " && echo done"),
    ("RUN curl -s http://get.example/", " | bash"),
    ("COPY . /srv/", ""),
    ("ADD ", ".tar.gz /opt"),
    ("ADD ", " /opt"),
    ("# ", ""),
    ("", ""),
    ('RUN echo "a # b" ', " # note"),
    ("  env K=", " \\"),
    ("RUN make && \\", ""),
    ("RUN apt-get install -y --no-install-recommends ", " && rm -rf /var/lib/apt/lists/*"),
    ("RUN apt-get update && apt-get install -y ", " \\"),
    ("USER app-", ""),
    ("HEALTHCHECK CMD ", ""),
    ("# syntax=docker/", ""),
    ("RUN ", ""),
    ("WORKDIR /w ", "   "),
    ("RUN apt-get install x ", " &&"),
    ('LABEL t="', ""),
    ("   cmake ", " && \\"),
)
BLANK_TEMPLATE = 10
BASES = ("FROM ubuntu:22.04", "FROM debian", "FROM alpine:latest", "from registry:5000/img AS b", "# base\nFROM x:latest AS b")
PATHS = ("Dockerfile", "docker/Dockerfile.gpu", "sub/dockerfile", "README.md", "Dockerfile.dev")
FRAGMENT_BREAK = r"\. |\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table, in the splits it comes in."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out to all tasks: a table that comes in one split feeds as many as there are."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def pick(values: tuple[str | None, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_id, repo_id, repo_url, path, content``; all documents, build files or not."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", FRAGMENT_BREAK).alias("frags"))
    before = F.array(*[F.lit(a) for a, _ in LINE_TEMPLATES])
    after = F.array(*[F.lit(b) for _, b in LINE_TEMPLATES])

    def line(fragment: Column, i: Column) -> Column:
        n = ((F.col("doc_id") + (i + 1) * 5 + F.length(fragment)) % len(LINE_TEMPLATES) + 1).cast("int")
        return F.when(n == BLANK_TEMPLATE + 1, F.lit("")).otherwise(
            F.concat(F.element_at(before, n), fragment, F.element_at(after, n))
        )

    repo = F.col("doc_id") - F.col("doc_id") % 3
    return docs.select(
        F.col("doc_id").alias("file_id"),
        repo.alias("repo_id"),
        repo_url(repo).alias("repo_url"),
        F.concat(F.lit("r"), repo.cast("string"), F.lit("/"), pick(PATHS, F.col("doc_id"))).alias("path"),
        F.array_join(F.concat(F.array(pick(BASES, F.col("doc_id"))), F.transform("frags", line)), "\n").alias("content"),
    )


def repo_url(repo: Column) -> Column:
    return F.concat(F.lit("https://git.example/acme/repo-"), repo.cast("string"))


def repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``repo_id, repo_url``: one per customer, most of them without files."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("repo_id"), repo_url(F.col("c_custkey")).alias("repo_url")
    )


def repo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_no, line`` of a repository list with comments, blanks and comma lists."""
    key, name = F.col("c_custkey"), F.lower("c_mktsegment")
    url = F.concat(F.lit("https://git.example/"), name, F.lit("/r"), key.cast("string"))
    line = (
        F.when(key % 6 == 0, F.concat(F.lit("# "), url))
        .when(key % 6 == 1, F.lit("   "))
        .when(key % 6 == 2, F.concat(F.lit("  "), url, F.lit(".git ")))
        .when(key % 6 == 3, F.concat(name, F.lit(", "), url, F.lit(" ,"), url, F.lit("/tree/master")))
        .when(key % 6 == 4, F.concat(url, F.lit(","), url, F.lit("/b")))
        .otherwise(F.concat(F.lit(" # "), name))
    )
    return table(spark, sf_dir, "customer").select(key.alias("line_no"), line.alias("line"))


def repo_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A classification sheet with section rows mixed in."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(key % 50 == 0, F.lit("Section")).otherwise(key.cast("string")).alias("Id"),
        mined_repo(key).alias("Repo"),
        pick(("Yes", "No", "yes"), key).alias("Uses Docker ?"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "Yes").otherwise("No").alias("Is CPS related/specific"),
    )


def mined_repo(key: Column) -> Column:
    return F.concat(F.lit("https://git.example/o"), (key % 25).cast("string"), F.lit("/r"), key.cast("string"))


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``topic, json``: code-search replies of two hits, hits shared between topics."""
    key = F.col("c_custkey")

    def hit(k: Column) -> Column:
        return F.struct(
            F.concat(F.lit("https://git.example/s/"), k.cast("string")).alias("html_url"),
            (k % 40).alias("stargazers_count"),
            (k % 3 == 0).alias("fork"),
        )

    page = F.to_json(F.struct(F.array(hit(key), hit(key + 1)).alias("items")))
    json = F.when(key % 17 == 0, F.lit('{"message":"limit"}')).otherwise(page)
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("topic"), json.alias("json"))


def _strings(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def image_captures(rows: DataFrame) -> DataFrame:
    """``image_id, json`` from part rows, batch or stream: inspect output, some of it empty or malformed."""
    key, size = F.col("p_partkey"), F.col("p_size")
    many = [f"V{i}={i}" for i in range(12)]
    env = (
        F.when(key % 6 == 0, _strings("PATH=/bin", "PIP_NO_CACHE_DIR=1"))
        .when(key % 6 == 1, _strings("PYTHONUNBUFFERED=1", "NOEQ", "A=b=c", "A=d"))
        .when(key % 6 == 2, F.array().cast("array<string>"))
        .when(key % 6 == 4, _strings("PIP_NO_CACHE_DIR=0", "PIP_NO_CACHE_DIR=true"))
        .when(key % 6 == 5, _strings(*many))
    )
    cmd = (
        F.when(key % 5 == 0, _strings("python", "app.py"))
        .when(key % 5 == 1, _strings("/bin/sh", "-c", "Python3 x"))
        .when(key % 5 == 2, _strings("nginx"))
        .when(key % 5 == 4, F.array().cast("array<string>"))
    )
    labels = (
        F.when(key % 3 == 0, F.create_map(F.lit("org.opencontainers.image.source"), F.col("p_name")))
        .when(key % 9 == 1, F.map_from_arrays(_strings(*[f"l{i:02d}" for i in range(12)]), _strings(*["v"] * 12)))
        .when(key % 3 == 1, F.create_map().cast("map<string,string>"))
    )
    doc = F.struct(
        F.concat(F.lit("sha256:"), F.md5(key.cast("string"))).alias("Id"),
        F.when(key % 4 != 0, F.array(F.concat(F.lit("img:"), key.cast("string")))).alias("RepoTags"),
        F.lit("2024-01-01T00:00:00Z").alias("Created"),
        image_bytes().alias("Size"),
        image_bytes().alias("VirtualSize"),
        F.lit("amd64").alias("Architecture"),
        F.lit("linux").alias("Os"),
        F.struct(digests().alias("Layers")).alias("RootFS"),
        F.struct(
            pick((None, "", "root", "app"), key).alias("User"),
            pick(("", "/srv", None), key).alias("WorkingDir"),
            env.alias("Env"),
            cmd.alias("Cmd"),
            F.when(key % 8 == 0, _strings("/entry", "--x")).alias("Entrypoint"),
            labels.alias("Labels"),
            F.when(key % 2 == 0, F.create_map(F.lit("80/tcp"), F.create_map().cast("map<string,string>"))).alias(
                "ExposedPorts"
            ),
            F.when(key % 7 == 0, F.struct(_strings("CMD", "true").alias("Test"))).alias("Healthcheck"),
        ).alias("Config"),
    )
    text = (
        F.when(key % 11 == 0, F.lit("[]"))
        .when(key % 13 == 0, F.lit('[{"Id":'))
        .otherwise(F.concat(F.lit("["), F.to_json(doc), F.lit("]")))
    )
    return rows.select(key.alias("image_id"), text.alias("json"))


def image_bytes() -> Column:
    return F.floor(F.col("p_retailprice") * F.col("p_size") * 40000).cast("long")


def digests() -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.col("p_size")), lambda i: F.concat(F.lit("sha256:"), F.md5(i.cast("string")))
    )


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.images(image_captures(table(spark, sf_dir, "part")))


def histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``image_id, history, digests``: entries oldest first; every third entry has no size."""
    entry = F.transform(
        F.sequence(F.lit(1), F.col("p_size")),
        lambda i: F.struct(
            F.concat(F.lit("h"), i.cast("string")).alias("layer_id"),
            F.when(i % 3 == 0, F.lit(0)).otherwise(i * 1000).cast("long").alias("size_bytes"),
        ),
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("image_id"), entry.alias("history"), digests().alias("digests")
    )


LAYER_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"]


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``image_id, layer_id, created_by, comment, size_bytes, size_text`` and the order columns."""
    q = F.floor(F.col("l_quantity") * 10).cast("string")
    text = (
        F.when(F.col("l_suppkey") % 5 == 0, F.lit("0B"))
        .when(F.col("l_suppkey") % 5 == 1, F.concat(q, F.lit(" MB")))
        .when(F.col("l_suppkey") % 5 == 2, F.concat(q, F.lit(".5MB")))
        .when(F.col("l_suppkey") % 5 == 3, F.concat(F.col("l_linenumber").cast("string"), F.lit(".25 GB")))
        .otherwise(F.concat(q, F.lit(" kB")))
    )
    made = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("image_id"),
        F.concat(F.lit("sha256:"), F.md5(F.concat_ws("-", "l_orderkey", "l_linenumber"))).alias("layer_id"),
        F.concat(F.lit("RUN   step "), F.col("l_returnflag"), F.lit("  "), F.repeat(F.lit("x"), (F.col("l_quantity") * 2).cast("int"))).alias("created_by"),
        F.when(F.col("l_linestatus") == "O", "cached").otherwise("").alias("comment"),
        F.when(F.col("l_linenumber") == 7, 0).otherwise(F.floor("l_extendedprice") * 10000).cast("long").alias("size_bytes"),
        text.alias("text"),
        *LAYER_ORDER,
    )
    # The size text stands for a stored column: filters must not rebuild it.
    return hold(made, [c for c in made.columns if c != "text"], F.col("text"), "size_text")


def container_captures(rows: DataFrame) -> DataFrame:
    """``container_id, ts, event_id, json`` from event rows, batch or stream."""
    key, kind = F.col("event_id"), F.col("event_type")
    health = F.floor("value") % 3
    ports = (
        F.when(key % 6 == 0, F.lit('{"80/tcp":null}'))
        .when(key % 6 == 1, F.lit('{"80/tcp":[{"HostIp":"","HostPort":"80"}]}'))
        .when(key % 6 == 2, F.lit("{}"))
        .otherwise(F.lit("null"))
    )
    restart = F.when(key % 10 == 9, F.lit("null")).otherwise(
        F.concat(F.lit('{"Name":"'), pick(("", "no", "always"), key), F.lit('"}'))
    )
    log = F.when(key % 5 == 3, F.lit("{}")).otherwise(
        F.concat(F.lit('{"Type":"'), pick(("", "json-file", "syslog", "", "journald"), key), F.lit('"}'))
    )
    user = F.when(key % 4 == 0, F.lit("null")).otherwise(F.concat(F.lit('"'), pick(("", "", "root", "svc"), key), F.lit('"')))
    status = F.when(health == 0, F.lit("null")).otherwise(
        F.concat(F.lit('{"Status":"'), F.when(health == 1, "healthy").otherwise("unhealthy"), F.lit('"}'))
    )
    text = F.concat(
        F.lit('[{"Id":"c'), F.col("user_id").cast("string"),
        F.lit('","State":{"Running":'), (kind != "error").cast("string"), F.lit(',"Health":'), status,
        F.lit('},"Config":{"User":'), user,
        F.lit('},"HostConfig":{"RestartPolicy":'), restart,
        F.lit(',"Privileged":'), (kind == "signup").cast("string"),
        F.lit(',"Memory":'), F.when(key % 2 == 0, "0").otherwise("512"),
        F.lit(',"LogConfig":'), log,
        F.lit('},"NetworkSettings":{"Ports":'), ports, F.lit("}}]"),
    )
    return rows.select(
        F.col("user_id").alias("container_id"), "ts", "event_id", F.when(key % 97 == 0, F.lit("[]")).otherwise(text).alias("json")
    )


CONTAINER_KEYS = ("container_id", "ts", "event_id")


def container_snapshots(rows: DataFrame) -> DataFrame:
    return snapshots.containers(container_captures(rows), CONTAINER_KEYS)


def prs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``project, pnumber, n_files, n_commits, title, pos``; every number occurs twice."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("p"), (key % 20).cast("string")).alias("project"),
        F.floor(key / 40).alias("pnumber"),
        (F.floor("o_totalprice") % 9).cast("int").alias("n_files"),
        (F.col("o_custkey") % 4).cast("int").alias("n_commits"),
        F.concat(F.lit("change "), key.cast("string")).alias("title"),
        key.alias("pos"),
    )


DIFF_PATHS = (
    "src/m{}.cpp", "docs/x{}.md", "a/docs/x{}.cpp", "ci/run{}.sh", ".github/workflows/w{}.yml", "README.txt",
    "build/Makefile", "docker/Dockerfile", "cmake/x{}.cmake", "img/a{}.png", "third_party/lib{}/CMakeLists.in",
    "scripts/tool{}.py",
)


def diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``project, pnumber, diff_text``: one changed file per text, some renamed, some with blanks."""
    key, n = F.col("l_orderkey"), F.col("l_linenumber")
    path = F.replace(pick(DIFF_PATHS, F.col("l_suppkey")), F.lit("{}"), (F.col("l_partkey") % 50).cast("string"))
    old = F.when(n == 6, F.lit("old/name.c")).when(n == 5, F.concat(F.lit("my "), path)).otherwise(path)
    new = F.when(n == 5, F.concat(F.lit("my "), path)).otherwise(path)
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("p"), (key % 20).cast("string")).alias("project"),
        F.floor(key / 40).alias("pnumber"),
        F.concat(
            F.lit("diff --git a/"), old, F.lit(" b/"), new, F.lit("\nindex 1..2\n--- a/"), old, F.lit("\n+++ b/"), new, F.lit("\n@@ -1 +1 @@\n+x")
        ).alias("diff_text"),
    )


def patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    pattern = (
        F.when(key % 3 == 0, F.concat(F.lit("lib"), size, F.lit("/")))
        .when(key % 3 == 1, F.concat(F.lit("src/m"), size, F.lit(".")))
        .otherwise(F.lit(" "))
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("p"), (key % 20).cast("string")).alias("project"), pattern.alias("pattern")
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source, content``; every fourth text ends in a line break, as files do."""
    end = F.when(F.col("doc_id") % 4 == 0, F.lit("\n")).otherwise(F.lit(""))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source"), F.concat("text", end).alias("content"))


LOG_KEYWORDS = ("license", "http", "THE")


def commit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``repo_url, sha, filename, change_type``."""
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        mined_repo(F.col("user_id")).alias("repo_url"),
        F.md5(F.floor(key / 2).cast("string")).alias("sha"),
        pick(("Dockerfile", "docker-compose.yml", "main.c", ".dockerignore", "chart.yaml"), F.floor("value").cast("long") + key).alias(
            "filename"
        ),
        pick(("ADD", "MODIFY", "DELETE", "RENAME"), key).alias("change_type"),
    )


LONG_LIST = 200  # some replies list so many risks, which is some thousand characters
def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``repo_url, sha, author, message``: one commit for each repository and pair of events, from the first of them."""
    key = F.col("event_id")
    first = F.min("event_id").alias("event_id")
    made = table(spark, sf_dir, "events").groupBy("user_id", F.floor(key / 2).alias("pair")).agg(first)
    return made.select(
        mined_repo(F.col("user_id")).alias("repo_url"),
        F.md5(F.col("pair").cast("string")).alias("sha"),
        F.concat(F.lit("dev"), (key % 7).cast("string")).alias("author"),
        F.concat(F.lit("change "), key.cast("string")).alias("message"),
    )


MISSING = ("no USER", "no HEALTHCHECK", "no labels", "ADD used", "no tag", "no owner", "no cleanup", "no limits", "no docs")
SLOW = ("Layer cache grows", "slow start", "Reduce image size", "Layer cache grows")
CATEGORIES = ("security", "performance", "best_practice", "optimization", "other")


def reply_parts(rows: DataFrame) -> DataFrame:
    """The analysis each reply is meant to carry, as columns."""
    conv, turn = F.col("conv_id"), F.col("turn")
    n_rec = (conv % 23).cast("int")
    return rows.select(
        (conv * 8 + turn).alias("id"),
        conv,
        turn,
        "role",
        "text",
        F.transform(
            F.slice(F.sequence(F.lit(1), F.lit(LONG_LIST)), 1, F.when(conv % 20 == 6, LONG_LIST).otherwise(turn % 4 + conv % 3).cast("int")),
            lambda k: F.concat(F.lit('open "port" '), (k % 4).cast("string")),
        ).alias("security_risks"),
        F.slice(F.array(*[F.lit(x) for x in SLOW]), 1, (F.length("text") % 5).cast("int")).alias("performance_issues"),
        F.when(conv % 3 == 0, F.array().cast("array<string>"))
        .when(conv % 3 == 1, _strings("use multi-stage builds"))
        .otherwise(_strings("minimize layers", "pin versions"))
        .alias("optimization_opportunities"),
        F.slice(F.array(*[F.lit(x) for x in MISSING]), 1, ((conv + turn) % 10).cast("int")).alias("best_practices_missing"),
        ((conv * 37) % 1000 * 1.5).alias("estimated_wasted_space_kb"),
        (turn % 10 + 0.5).alias("complexity_score"),
        (conv % 10).alias("maintainability_score"),
        F.transform(
            F.slice(F.sequence(F.lit(1), F.lit(40)), 1, n_rec),
            lambda k: F.struct(
                F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), k * k % 5 + 1).alias("category"),
                F.when(k % 3 != 0, F.lit("high")).alias("severity"),
                F.concat(F.lit("do "), k.cast("string")).alias("message"),
                (k % 4).alias("instruction_line"),
            ),
        ).alias("recommendations"),
    )


REPLY_FIELDS = (
    "security_risks", "performance_issues", "optimization_opportunities", "best_practices_missing",
    "estimated_wasted_space_kb", "complexity_score", "maintainability_score", "recommendations",
)


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, raw``: a model reply per conversation turn in ten shapes, from clean to broken."""
    parts = reply_parts(table(spark, sf_dir, "conversations"))
    json = F.to_json(F.struct(*REPLY_FIELDS, F.col("text").alias("overall_assessment")))
    made = parts.select("id", ((F.col("conv_id") + F.col("turn")) % 10).alias("shape"), json.alias("json"))
    shape, cut = F.col("shape"), F.substring("json", F.lit(1), F.length("json") - 1)
    raw = (
        F.when(shape == 1, F.concat(F.lit("```json\n"), F.col("json"), F.lit("\n```")))
        .when(shape == 2, F.concat(F.lit("Result:\n```\n"), F.col("json"), F.lit("\n```\nbye")))
        .when(shape == 3, F.concat(F.col("json"), F.lit(" } and more")))
        .when(shape == 4, cut)
        .when(shape == 5, F.lit("LLM API error: 429 out of quota"))
        .when(shape == 6, F.concat(F.substring_index("json", ',"overall_assessment"', 1), F.lit(',"overall_assessment":"cut off')))
        .when(shape == 7, F.concat(F.lit("No findings. "), F.col("id").cast("string")))
        .when(shape == 8, F.lit('{"security_risks":null,"complexity_score":"high","estimated_wasted_space_kb":null}'))
        .when(shape == 9, F.lit("  "))
        .otherwise(F.col("json"))
    )
    return made.select("id", raw.alias("raw"))


def fix_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_id, raw``: replies that carry a build file in seven shapes."""
    conv, turn, text = F.col("conv_id"), F.col("turn"), F.col("text")
    body = F.concat(F.lit("FROM debian:12\nRUN make\n# "), F.col("role"), F.lit("\n\nCMD run "), conv.cast("string"))
    shape = (conv * 3 + turn) % 7
    raw = (
        F.when(shape == 1, F.concat(F.lit("```dockerfile\n"), body, F.lit("\n```")))
        .when(shape == 2, F.concat(text, F.lit("\n```\n"), body, F.lit("\n```\n"), text))
        .when(shape == 3, F.concat(body, F.lit("\n```\n"), text))
        .when(shape == 4, F.concat(text, F.lit("\nRUN only\n")))
        .when(shape == 5, F.lit("Error: 401 invalid key"))
        .when(shape == 6, text)
        .otherwise(body)
    )
    return table(spark, sf_dir, "conversations").select((conv * 8 + turn).alias("file_id"), raw.alias("raw"))


BUILD_LINES = (
    "Step 1/5 : RUN x", " ---> abc", "exporting 12 MB done", "size:  1.5 GB", "Successfully tagged x:latest", "",
    "MB only", "copied 300 KB at 5 MB/s", "read /Step logs",
)
BUILD_ORDER = ["l_linenumber", "l_partkey", "l_suppkey"]


def build_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("build_id"), *BUILD_ORDER, pick(BUILD_LINES, F.col("l_partkey")).alias("line")
    )


def build_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("build_id"),
        F.when(status == "F", 0).when(status == "O", 1).alias("return_code"),
        (F.floor("o_totalprice") / 1024).alias("seconds"),
        F.concat(F.lit("exit "), status).alias("stderr"),
    )


def stage_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``repo_id, stage, image_size, build_success``.

    Stages that no order of a repository names are the absent ones.
    """
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.floor(key / 3).alias("repo_id"),
        pick(("original", "static_optimized", "llm_optimized", "llm_optimized", "original"), F.col("o_custkey")).alias("stage"),
        F.when((F.col("o_orderstatus") != "P") & (key % 7 != 0), F.concat((F.col("o_custkey") % 900 + 1).cast("string"), F.lit("MB"))).alias(
            "image_size"
        ),
        (F.col("o_orderstatus") != "P").alias("build_success"),
    )


def test_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("file_id"),
        (F.col("o_orderstatus") != "P").alias("stage_ok"),
        (key % 4 == 0).alias("test_skipped"),
        F.when(key % 4 == 1, True).when(key % 4 == 2, False).alias("test_success"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id`` and two raters for two questions."""
    key = F.col("doc_id")

    def second(col: str, k: int) -> Column:
        return F.when(key % 13 == 0, None).when(key % k == 0, 1 - F.col(col)).otherwise(F.col(col))

    return table(spark, sf_dir, "labels").select(
        "doc_id",
        F.col("quality").alias("quality_1"),
        second("quality", 7).alias("quality_2"),
        F.col("toxic").alias("toxic_1"),
        second("toxic", 11).alias("toxic_2"),
    )


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat(
        F.col("p_type"), F.when(F.col("p_size") % 10 == 0, F.lit("")).otherwise(F.concat(F.lit("_"), F.col("p_brand"), F.lit("_s"), F.col("p_size").cast("string")))
    )
    return (
        table(spark, sf_dir, "part")
        .groupBy(label.alias("label"))
        .agg(F.count("*").alias("freq"), F.when(F.bool_or(F.col("p_size") % 4 == 0), "YES").otherwise("NO").alias("is_new"))
    )


def relation_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_no, left_label, right_label``; a blank left label means the label above."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("row_no"),
        F.when(key % 5 == 1, F.concat_ws("-", "o_orderpriority", "o_custkey")).otherwise("").alias("left_label"),
        F.col("o_orderstatus").alias("right_label"),
    )


def observed_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``repo, before, static, final`` as written by hand, with in-band sentinels."""
    key, size = F.col("p_partkey"), F.col("p_size")
    num = size.cast("string")
    return table(spark, sf_dir, "part").select(
        key.alias("repo"),
        F.when(key % 9 == 0, "BUILD_FAILED").otherwise(F.concat(num, F.lit(".5GB"))).alias("before"),
        F.when(key % 4 == 0, "NO_OPTIMIZATIONS").otherwise(F.concat((size * 20).cast("string"), F.lit(" MB"))).alias("static"),
        F.when(key % 5 == 0, "BUILD_FAILED").when(key % 7 == 0, "n/a ").when(key % 11 == 0, F.concat((size + 1).cast("string"), F.lit("GB"))).otherwise("N/A").alias("final"),
    )


def chunks(rows: DataFrame) -> DataFrame:
    """``id, seq, text, finish_reason`` from conversation rows, batch or stream."""
    words = rows.select((F.col("conv_id") * 8 + F.col("turn")).alias("id"), F.split("text", " ").alias("w"))
    at = words.select("id", F.size("w").alias("n"), F.posexplode("w").alias("seq", "word"))
    return at.select(
        "id",
        F.col("seq").cast("long").alias("seq"),
        F.when(F.col("seq") == 0, F.col("word")).otherwise(F.concat(F.lit(" "), F.col("word"))).alias("text"),
        F.when(F.col("seq") == F.col("n") - 1, F.lit("stop")).alias("finish_reason"),
    )


# --- streams in several micro-batches ----------------------------------------------------------------

#: Rows of one file of a micro-batch.
FILE_ROWS = 500_000
MICRO_BATCHES = 4


def in_batches(df: DataFrame, folder: str) -> DataFrame:
    """A stream of ``df`` (with ``arrival`` from 0) that takes the rows of one arrival after the other, each as a micro-batch.

    Every arrival is written as the same number of files, and a micro-batch takes that many.
    """
    spark = df.sparkSession
    files = max(1, df.count() // MICRO_BATCHES // FILE_ROWS)
    for k in range(MICRO_BATCHES):
        df.filter(F.col("arrival") == k).drop("arrival").repartition(files).write.mode("append").parquet(folder)
    rows = df.drop("arrival").schema
    return spark.readStream.schema(rows).option("maxFilesPerTrigger", files).parquet(folder)


def event_arrivals(spark: SparkSession, sf_dir: str, late: bool = True) -> DataFrame:
    """``events`` with ``arrival``: a quarter of the time each; some rows of the first quarter come last, too late (or are left out).

    Every twentieth event is delivered twice.
    """
    # Times without a zone are taken as UTC, whatever the session's zone is.
    utc = F.to_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    events = table(spark, sf_dir, "events").withColumn("ts", utc)
    lo, hi = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    quarter = F.expr(f"cast((unix_micros(ts) - {lo}) * {MICRO_BATCHES} div {hi - lo + 1} as int)")
    delayed = (quarter == 0) & (F.col("event_id") % 50 == 7)
    arrived = events.withColumn("arrival", F.when(delayed, MICRO_BATCHES - 1).otherwise(quarter)).filter(F.lit(late) | ~delayed)
    return arrived.unionByName(arrived.filter(F.col("event_id") % 20 == 3))


def timed_chunks(spark: SparkSession, sf_dir: str, late: bool = True) -> DataFrame:
    """``id, seq, text, finish_reason, ts, arrival``: sentences of the conversations as they come.

    Some completions never finish, some lack a chunk, some chunks come twice, some in the next micro-batch, and some far too late (or are left out).
    """
    rows = table(spark, sf_dir, "conversations")
    convs = (rows.agg(F.max("conv_id")).first()[0] or 0) + 1
    parts = rows.select("conv_id", "turn", (F.col("conv_id") * 8 + F.col("turn")).alias("id"), F.split("text", r"\. ").alias("p"))
    at = parts.select("conv_id", "turn", "id", F.size("p").alias("n"), F.posexplode("p").alias("seq", "text"))
    seconds = 1_704_067_200 + F.col("conv_id") * 300 + F.col("turn") * 3 + F.col("seq")
    quarter = F.floor(F.col("conv_id") * MICRO_BATCHES / convs).cast("int")
    near = F.floor((F.col("conv_id") + 1) * MICRO_BATCHES / convs).cast("int")  # within the allowed delay of the next batch
    delayed = (quarter == 0) & (F.col("id") % 13 == 4) & (F.col("seq") == 0)
    at = at.filter(F.lit(late) | ~delayed)
    arrival = F.when(delayed, MICRO_BATCHES - 1).when(F.col("seq") % 2 == 1, F.least(near, F.lit(MICRO_BATCHES - 1))).otherwise(quarter)
    made = at.select(
        "id",
        F.col("seq").cast("long").alias("seq"),
        "text",
        F.when((F.col("seq") == F.col("n") - 1) & (F.col("id") % 7 != 3), F.lit("stop")).alias("finish_reason"),
        F.timestamp_seconds(seconds).alias("ts"),
        arrival.cast("int").alias("arrival"),
    ).filter(~((F.col("id") % 11 == 5) & (F.col("seq") == 1)))
    return made.unionByName(made.filter((F.col("id") % 5 == 2) & (F.col("seq") == 0)))


# --- files to read back --------------------------------------------------------------------------------


def pull_request_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a pull-request CSV: titles with commas and quotes, bodies over several lines."""
    key = F.col("o_orderkey")
    body = F.concat(
        F.lit('He said: "'), F.col("o_orderpriority"), F.lit('"\n\n- item, '), F.col("o_custkey").cast("string"), F.when(key % 3 == 0, F.lit("\r\n;end\n")).otherwise("")
    )
    merged = F.when(key % 2 == 0, "True").otherwise("False")
    return prs(spark, sf_dir).join(table(spark, sf_dir, "orders"), F.col("pos") == key).select(
        F.col("project").alias("Project"), F.col("pnumber").alias("PNumber"), F.lit("2024-01-02 03:04:05").alias("CreatedAt"), F.lit("None").alias("ClosedAt"),
        merged.alias("isMerged"), F.lit("none").alias("MergedAt"), F.md5("title").alias("MergedCommit"), F.col("n_files").alias("nFiles"), F.col("n_commits").alias("nCommits"),
        F.concat(F.lit("c1 c2  "), F.md5("title")).alias("Commits"), F.lit("a,b").alias("Labels"), F.concat("title", F.lit(', "quoted"')).alias("Title"), body.alias("Body"),
    )


def annotation_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two raters' answers to the questions of the annotation sheet, as text with separators and line breaks."""
    key = F.col("doc_id")
    asked = [
        F.concat(F.lit(f"q{k};r{r}\n"), (key % (k + r + 1)).cast("string")).alias(f"{k}-{r}") for k in range(6) for r in (1, 2)
    ]
    return table(spark, sf_dir, "labels").select(F.concat(F.lit("p"), (key % 20).cast("string")).alias("Project"), key.alias("Number"), *asked)
