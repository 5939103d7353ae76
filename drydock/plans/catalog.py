"""The query catalogue: every operator over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import buildfile, paths, rewrites, sizes
from ..functions import replies as rp
from ..operators import (
    buildlogs,
    containers,
    images,
    labels,
    ledger,
    lint,
    logs,
    mining,
    replies,
    repos,
    rewrite,
    savings,
    scorecard,
)
from ..session import work_dir
from ..sources import commits
from ..sources import files as file_sources
from ..sources import repos as repo_sources
from ..sources import sheets, sinks, snapshots
from ..streaming import completions, transitions, watch
from . import flows
from . import frames as fr

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _build_files(spark: SparkSession, sf: str) -> DataFrame:
    return repos.build_files(fr.files(spark, sf))


# --- build files -------------------------------------------------------------------------------


@query
def file_discovery(spark: SparkSession, sf: str) -> DataFrame:
    return _build_files(spark, sf).select(
        "file_id", "path", "file_name", buildfile.is_plausible(F.col("content")).alias("is_plausible")
    )


@query
def corpus_instructions(spark: SparkSession, sf: str) -> DataFrame:
    return lint.instructions(_build_files(spark, sf))


@query
def lint_findings(spark: SparkSession, sf: str) -> DataFrame:
    found = lint.findings(_build_files(spark, sf))
    return found.withColumn("location", lint.location(F.col("idx")))


@query
def lint_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lint.counts_in_row(_build_files(spark, sf))


@query
def lint_size_only(spark: SparkSession, sf: str) -> DataFrame:
    return flows.size_lint(fr.files(spark, sf), profile=True)


@query
def lint_size_related(spark: SparkSession, sf: str) -> DataFrame:
    return flows.size_lint(fr.files(spark, sf)).groupBy("rule_id").agg(F.count("*").alias("n"))


@query
def lint_size_review(spark: SparkSession, sf: str) -> DataFrame:
    found = lint.review_profile(lint.findings(_build_files(spark, sf)))
    return found.groupBy("rule_id").agg(F.count("*").alias("n"))


@query
def lint_missing_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth file stands for one that could not be read."""
    files = _build_files(spark, sf)
    unread = files.withColumn("content", F.when(F.col("file_id") % 10 != 0, F.col("content")))
    return lint.findings(unread).filter("rule_id = 'missing_file'")


@query
def file_savings(spark: SparkSession, sf: str) -> DataFrame:
    return savings.savings_in_row(_build_files(spark, sf))


@query
def file_savings_topk(spark: SparkSession, sf: str) -> DataFrame:
    return savings.top_files(savings.savings_in_row(_build_files(spark, sf)), 20)


@query
def rewrite_flags(spark: SparkSession, sf: str) -> DataFrame:
    lines = _build_files(spark, sf).select("file_id", F.split("content", "\n").alias("lines"))
    counted = lines.select(
        "file_id",
        rewrites.count_flag_edits(F.col("lines"), rewrites.APT_INSTALL, rewrites.APT_FLAG).alias("n_apt"),
        rewrites.count_flag_edits(F.col("lines"), rewrites.PIP_INSTALL, rewrites.PIP_FLAG).alias("n_pip"),
        rewrites.add_flag(F.col("lines"), rewrites.APT_INSTALL, rewrites.APT_FLAG).alias("lines"),
    )
    both = rewrites.add_flag(F.col("lines"), rewrites.PIP_INSTALL, rewrites.PIP_FLAG)
    return counted.select("file_id", "n_apt", "n_pip", F.md5(F.array_join(both, "\n")).alias("text_md5"))


@query
def rewrite_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    lines = _build_files(spark, sf).select("file_id", F.split("content", "\n").alias("lines"))
    return lines.select(
        "file_id",
        rewrites.count_cleanup_hits(F.col("lines")).alias("n_hits"),
        rewrites.count_dangling_hits(F.col("lines")).alias("n_dangling"),
        F.md5(F.array_join(rewrites.add_cleanup(F.col("lines")), "\n")).alias("text_md5"),
    )


@query
def static_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    done = rewrite.static_rewrite(_build_files(spark, sf))
    return done.select(
        "file_id", "changed", F.col("n_changes").cast("long").alias("n_changes"), F.col("saving_kb").cast("long").alias("saving_kb"),
        F.md5("rewritten").alias("text_md5"),
    )


@query
def safe_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    done = rewrite.static_rewrite(_build_files(spark, sf), safe_cleanup=True)
    return done.select(
        "file_id", "changed", F.col("n_changes").cast("long").alias("n_changes"), F.md5("rewritten").alias("text_md5")
    )


@query
def stage_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The texts of all stages written one folder per stage, and read back."""
    files = _build_files(spark, sf)
    done = rewrite.static_rewrite(files, ["file_id", "repo_id", "file_name"])
    model = replies.fixed_files(fr.fix_replies(spark, sf), files).filter("status = 'ok'")
    keys = ["file_id"]
    stages = rewrite.stage_texts(
        done, model.select("file_id", F.col("fixed").alias("content")), keys
    )
    names = done.select("file_id", "repo_id", "file_name")
    out = work_dir(spark, "stages")
    sinks.write_stage_texts(stages, out)
    back = spark.read.parquet(out).join(names, "file_id")
    return back.select(
        paths.variant_key(F.col("repo_id").cast("string"), F.col("file_name"), F.col("stage")).alias("variant"),
        "file_id",
        "stage",
        F.md5("content").alias("text_md5"),
    )


# --- repositories ------------------------------------------------------------------------------


@query
def repo_list(spark: SparkSession, sf: str) -> DataFrame:
    urls = repo_sources.repo_urls(fr.repo_lines(spark, sf))
    return urls.select("line_no", "part", "url", paths.repo_name(F.col("url")).alias("repo_name"))


@query
def repo_list_plain(spark: SparkSession, sf: str) -> DataFrame:
    return repo_sources.plain_repo_urls(fr.repo_lines(spark, sf))


@query
def repo_list_first_and_kth(spark: SparkSession, sf: str) -> DataFrame:
    lines = fr.repo_lines(spark, sf)
    first = repo_sources.first_repo_url(lines).select(F.lit("first").alias("which"), "url")
    kth = repos.nth(repo_sources.plain_repo_urls(lines), F.col("line_no"), 17).select(F.lit("kth").alias("which"), "url")
    return first.unionByName(kth)


@query
def repo_list_limited(spark: SparkSession, sf: str) -> DataFrame:
    """The first URLs of both readings of a list, in list order."""
    lines = fr.repo_lines(spark, sf)
    split = repo_sources.limited(repo_sources.repo_urls(lines), 25, ("line_no", "part"))
    plain = repo_sources.limited(repo_sources.plain_repo_urls(lines), 25)
    return split.select(F.lit("split").alias("which"), "line_no", "url").unionByName(plain.select(F.lit("plain").alias("which"), "line_no", "url"))


@query
def repo_sheet(spark: SparkSession, sf: str) -> DataFrame:
    rows = repo_sources.repo_sheet(fr.repo_sheet(spark, sf).withColumn("pos", F.monotonically_increasing_id()))
    return rows.select("Id", "url")


@query
def relevant_repos(spark: SparkSession, sf: str) -> DataFrame:
    return mining.relevant_repos(repo_sources.classified_repos(fr.repo_sheet(spark, sf))).orderBy("repo")


@query
def search_hits(spark: SparkSession, sf: str) -> DataFrame:
    return mining.search_hits(snapshots.search_pages(fr.search_pages(spark, sf)))


@query
def first_file_per_repo(spark: SparkSession, sf: str) -> DataFrame:
    return repos.first_file(_build_files(spark, sf).select("repo_id", "path", "file_id"))


@query
def preferred_file_per_repo(spark: SparkSession, sf: str) -> DataFrame:
    return repos.preferred_file(_build_files(spark, sf).select("repo_id", "path", "file_id"))


@query
def repo_left_join_status(spark: SparkSession, sf: str) -> DataFrame:
    return repos.with_missing(fr.repos(spark, sf), _build_files(spark, sf), columns=("file_id", "path"))


@query
def fresh_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files whose content was not among the labelled (already processed) ones."""
    files = _build_files(spark, sf).select("file_id", repos.content_key(F.col("content")).alias("content_key"))
    done = files.join(fr.table(spark, sf, "labels").select(F.col("doc_id").alias("file_id")).distinct(), "file_id", "left_semi")
    return repos.fresh_only(files, done, ["content_key"])


@query
def size_run(spark: SparkSession, sf: str) -> DataFrame:
    replies_ = fr.responses(spark, sf).withColumnRenamed("id", "file_id")
    return flows.size_run(fr.repos(spark, sf), fr.files(spark, sf), replies_, fr.fix_replies(spark, sf))


@query
def corpus_summary(spark: SparkSession, sf: str) -> DataFrame:
    return savings.run_summary(size_run(spark, sf))


@query
def stage_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return savings.stage_sizes(fr.stage_builds(spark, sf))


@query
def result_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The result table written as CSV and read back."""
    out = work_dir(spark, "results")
    sinks.write_results(savings.stage_sizes(fr.stage_builds(spark, sf), images_built=False), out)
    schema = "repo_id long, original_size string, static_size string, llm_size string"
    return spark.read.csv(out, header=True, schema=schema)


# --- images and containers ---------------------------------------------------------------------


@query
def image_rules(spark: SparkSession, sf: str) -> DataFrame:
    return images.image_findings(fr.images(spark, sf), fr.layers(spark, sf))


@query
def image_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = images.image_summary(fr.images(spark, sf))
    return out.withColumn("env", F.array_join("env", "|")).withColumn("labels", F.array_join("labels", "|"))


@query
def env_map(spark: SparkSession, sf: str) -> DataFrame:
    env = fr.images(spark, sf).select("image_id", F.explode(images.env_map(F.col("doc.Config.Env"))).alias("key", "value"))
    return env


@query
def large_layers(spark: SparkSession, sf: str) -> DataFrame:
    return images.large_layers(fr.layers(spark, sf)).select("image_id", "layer_id", "size_text")


@query
def large_layers_strict(spark: SparkSession, sf: str) -> DataFrame:
    return images.large_layers(fr.layers(spark, sf), strict=True).select("image_id", "layer_id", "size_text")


@query
def large_layer_findings(spark: SparkSession, sf: str) -> DataFrame:
    return images.layer_findings(fr.layers(spark, sf))


@query
def size_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = fr.layers(spark, sf).select("size_text").distinct()
    return parsed.select("size_text", sizes.parse_size(F.col("size_text")).alias("p")).select("size_text", "p.*")


@query
def size_format(spark: SparkSession, sf: str) -> DataFrame:
    rows = fr.layers(spark, sf).select(F.col("size_bytes").alias("n")).distinct()
    return rows.select(
        "n",
        sizes.compact_size(F.col("n")).alias("compact"),
        sizes.spaced_size(F.col("n")).alias("spaced"),
        sizes.signed_size(-F.col("n")).alias("signed"),
    )


@query
def layer_cumulative_size(spark: SparkSession, sf: str) -> DataFrame:
    return images.layer_table(fr.layers(spark, sf), fr.LAYER_ORDER)


@query
def layer_digests(spark: SparkSession, sf: str) -> DataFrame:
    rows = fr.histories(spark, sf)
    matched = rows.select("image_id", F.posexplode(images.match_layers(F.col("history"), F.col("digests"))).alias("pos", "e"))
    return matched.select("image_id", "pos", "e.*")


@query
def container_rules(spark: SparkSession, sf: str) -> DataFrame:
    snaps = fr.container_snapshots(fr.table(spark, sf, "events"))
    return containers.container_findings(snaps, ["event_id", "container_id"])


@query
def container_transitions(spark: SparkSession, sf: str) -> DataFrame:
    snaps = fr.container_snapshots(fr.table(spark, sf, "events"))
    sets = containers.rule_sets(snaps, list(fr.CONTAINER_KEYS))
    out = containers.transitions(sets, "container_id", ["ts", "event_id"])
    return out.select("container_id", "event_id", "rule_id", "change")


@query
def listing_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Container listings from JSON lines, malformed lines dropped, running ones kept."""
    key = F.col("event_id")
    line = (
        F.when(key % 9 == 0, F.lit("  "))
        .when(key % 9 == 1, F.lit('{"ID":'))
        .otherwise(
            F.concat(F.lit('{"ID":"'), key.cast("string"), F.lit('","State":"'), fr.pick(("running", "exited"), F.floor("value").cast("long")), F.lit('"}'))
        )
    )
    lines = fr.table(spark, sf, "events").select(line.alias("line"))
    return snapshots.container_listing(lines).select("ID", "State")


# --- mining ------------------------------------------------------------------------------------


@query
def diff_changed_files(spark: SparkSession, sf: str) -> DataFrame:
    return mining.changed_files(fr.diffs(spark, sf))


@query
def pr_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return mining.dedup_prs(fr.prs(spark, sf))


@query
def pattern_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    return mining.matching_paths(mining.changed_files(fr.diffs(spark, sf)), fr.patterns(spark, sf))


@query
def pr_select(spark: SparkSession, sf: str) -> DataFrame:
    return mining.select_prs(fr.prs(spark, sf), mining.changed_files(fr.diffs(spark, sf)), fr.patterns(spark, sf))


@query
def commit_filter(spark: SparkSession, sf: str) -> DataFrame:
    wanted = mining.relevant_repos(repo_sources.classified_repos(fr.repo_sheet(spark, sf)))
    return mining.container_commits(fr.commit_files(spark, sf), wanted.withColumnRenamed("repo", "repo_url"))


@query
def commit_path_test(spark: SparkSession, sf: str) -> DataFrame:
    return mining.container_commits(fr.commit_files(spark, sf), path_test="container_and_deploy_files")


@query
def commit_details(spark: SparkSession, sf: str) -> DataFrame:
    return mining.join_commits(fr.commit_files(spark, sf), fr.commits(spark, sf))


@query
def commit_list_file(spark: SparkSession, sf: str) -> DataFrame:
    """Commit URLs written as sorted lines, read back and split."""
    out = work_dir(spark, "commits")
    sinks.write_sorted_lines(mining.container_commits(fr.commit_files(spark, sf)), "commit_url", out)
    return repo_sources.commit_urls(spark.read.text(out).withColumnRenamed("value", "line"))


@query
def commit_url_parts(spark: SparkSession, sf: str) -> DataFrame:
    return mining.split_commit_urls(mining.container_commits(fr.commit_files(spark, sf)))


@query
def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    urls = mining.container_commits(fr.commit_files(spark, sf))
    return repos.hash_sample(urls, F.col("commit_url"), 333, seed=7).orderBy("commit_url")


@query
def log_context(spark: SparkSession, sf: str) -> DataFrame:
    return logs.context_in_text(fr.logs(spark, sf), fr.LOG_KEYWORDS, radius=2)


@query
def log_context_by_line(spark: SparkSession, sf: str) -> DataFrame:
    return logs.context_in_lines(logs.number_lines(fr.logs(spark, sf)), fr.LOG_KEYWORDS, radius=2)


@query
def log_matches(spark: SparkSession, sf: str) -> DataFrame:
    return logs.matches(logs.number_lines(fr.logs(spark, sf)), fr.LOG_KEYWORDS)


# --- model replies -----------------------------------------------------------------------------


def _analyses(spark: SparkSession, sf: str) -> DataFrame:
    return replies.normalise(fr.responses(spark, sf))


@query
def analysis_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return replies.analysis_prompts(_build_files(spark, sf)).select("file_id", F.md5("prompt").alias("prompt_md5"))


@query
def fix_prompt(spark: SparkSession, sf: str) -> DataFrame:
    scored = scorecard.score(_analyses(spark, sf).withColumnRenamed("id", "file_id")).filter("scores is not null")
    return replies.fix_prompts(scored, _build_files(spark, sf)).select("file_id", "prompt")


@query
def response_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _analyses(spark, sf)
    return parsed.select(
        "id",
        "status",
        *[F.array_join(F.col("data")[f], "|").alias(f) for f in rp.LIST_FIELDS],
        *[F.col("data")[f].alias(f) for f in rp.NUMBER_DEFAULTS],
        F.col("data.overall_assessment").alias("overall_assessment"),
        F.size("data.recommendations").alias("n_recommendations"),
    )


@query
def response_salvage(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _analyses(spark, sf).filter("status = 'partial'")
    return parsed.select("id", *[F.array_join(F.col("data")[f], "|").alias(f) for f in rp.SALVAGE_FIELDS])


@query
def response_errors(spark: SparkSession, sf: str) -> DataFrame:
    both = _analyses(spark, sf).select("error").unionByName(
        fr.fix_replies(spark, sf).select(F.when(rp.is_api_error(F.col("raw")), F.col("raw")).alias("error"))
    )
    classed = both.select(rp.error_class(F.col("error")).alias("error_class"))
    return classed.groupBy("error_class").agg(F.count("*").alias("n"))


@query
def fixed_files(spark: SparkSession, sf: str) -> DataFrame:
    return replies.fixed_files(fr.fix_replies(spark, sf), fr.files(spark, sf))


@query
def model_size_issues(spark: SparkSession, sf: str) -> DataFrame:
    return replies.model_size_issues(_analyses(spark, sf))


@query
def model_review_issues(spark: SparkSession, sf: str) -> DataFrame:
    return replies.model_size_issues(_analyses(spark, sf), words=rp.REVIEW_WORDS)


@query
def analysis_json(spark: SparkSession, sf: str) -> DataFrame:
    """Nested analyses written as JSON lines and read back."""
    out = work_dir(spark, "analyses")
    parsed = _analyses(spark, sf).select("id", "status", "data")
    sinks.write_json(parsed, out)
    back = spark.read.schema(parsed.schema).json(out)
    return back.select("id", "status", F.size("data.recommendations").alias("n_recommendations"), F.array_join("data.security_risks", "|").alias("risks"))


@query
def pr_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Selected pull requests written as CSV with their input columns, and read back."""
    out = work_dir(spark, "prs")
    rows = mining.dedup_prs(fr.prs(spark, sf))
    sinks.write_rows(rows, out)
    return spark.read.schema(rows.schema).csv(out, header=True)


@query
def top5_per_category(spark: SparkSession, sf: str) -> DataFrame:
    return replies.top_recommendations(_analyses(spark, sf))


@query
def top5_issues(spark: SparkSession, sf: str) -> DataFrame:
    return replies.top_issues(_analyses(spark, sf))


@query
def model_call(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts through a callable in Arrow batches; a stub stands in for the model."""

    def stub(prompt: str) -> str:
        if len(prompt) % 5 == 0:
            raise RuntimeError("429")
        return f"FROM scratch\n# {len(prompt)}"

    prompts = replies.analysis_prompts(_build_files(spark, sf))
    return replies.call_model(prompts, stub)


@query
def model_answers(spark: SparkSession, sf: str) -> DataFrame:
    """A second run over kept answers: only the prompts that failed in the first one are asked again."""

    def first(prompt: str) -> str:
        if len(prompt) % 5 == 0:
            raise RuntimeError("429")
        return f"first {len(prompt)}"

    prompts = replies.analysis_prompts(_build_files(spark, sf))
    folder = work_dir(spark, "answers")
    replies.ask_once(prompts, first, folder)
    return replies.ask_once(prompts, lambda prompt: f"second {len(prompt)}", folder)


@query
def fresh_work(spark: SparkSession, sf: str) -> DataFrame:
    """Build files that a first run has not finished; a run that broke before its commit has finished none."""
    files = _build_files(spark, sf).select("repo_id", "file_id", "file_name")
    folder = work_dir(spark, "ledger")
    ledger.finish(files.filter("file_id % 3 = 0"), folder, ["repo_id", "file_id"])
    commits.write_segment(files.filter("file_id % 3 = 1"), folder, ledger.RESULTS)  # never committed
    return ledger.pending(files, folder, ["repo_id", "file_id"])


@query
def issue_scores(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard.score(_analyses(spark, sf)).select("id", "status", "scores.*")


def _before_after(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Replies to the original and to the fixed file: even and odd ids of a pair."""
    raw = fr.responses(spark, sf)
    keyed = raw.select((F.col("id") - F.col("id") % 2).alias("file_id"), (F.col("id") % 2).alias("after"), "raw")
    return keyed.filter("after = 0").drop("after"), keyed.filter("after = 1").drop("after")


def _compared(spark: SparkSession, sf: str) -> DataFrame:
    before, after = _before_after(spark, sf)
    both = scorecard.compare(
        scorecard.score(replies.normalise(before, "file_id")), scorecard.score(replies.normalise(after, "file_id"))
    )
    return both.filter("scores is not null and fixed_scores is not null")


@query
def score_improvement(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard.improvements(_compared(spark, sf))


@query
def issue_set_diff(spark: SparkSession, sf: str) -> DataFrame:
    out = scorecard.issue_changes(_compared(spark, sf))
    for c in ("fixed", "new", "remaining"):
        out = out.withColumn(c, F.array_join(F.array_sort(c), "|"))
    return out


def _scorecard(spark: SparkSession, sf: str) -> DataFrame:
    before, after = _before_after(spark, sf)
    return flows.scorecard_run(_build_files(spark, sf), before, fr.fix_replies(spark, sf), after)


@query
def scorecard_table(spark: SparkSession, sf: str) -> DataFrame:
    return _scorecard(spark, sf)


@query
def run_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Scorecard and metadata written as two tables; the metadata read back."""
    card = _scorecard(spark, sf)
    out = work_dir(spark, "scorecard")
    sinks.write_scorecard(card, scorecard.run_metadata, out)
    scores, meta = sinks.read_scorecard(spark, out)
    good = scorecard.stage_success(scores).agg(F.count_if("success").alias("n_success"))
    meta = meta.select("repo_count", "dockerfile_count")
    both = meta.unionByName(good, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("repo_count", "dockerfile_count", "n_success")])


# --- builds ------------------------------------------------------------------------------------


@query
def buildlog_extract(spark: SparkSession, sf: str) -> DataFrame:
    return buildlogs.extract(fr.build_lines(spark, sf), fr.BUILD_ORDER)


@query
def tail_lines(spark: SparkSession, sf: str) -> DataFrame:
    return buildlogs.tail(fr.build_lines(spark, sf), fr.BUILD_ORDER).select("build_id", "rank", "line")


@query
def build_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return buildlogs.outcomes(fr.build_runs(spark, sf))


@query
def failed_builds(spark: SparkSession, sf: str) -> DataFrame:
    return buildlogs.failed_builds(buildlogs.outcomes(fr.build_runs(spark, sf)))


@query
def status_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return buildlogs.status_rollup(fr.test_results(spark, sf))


@query
def batch_ok(spark: SparkSession, sf: str) -> DataFrame:
    return buildlogs.batch_ok(fr.test_results(spark, sf))


# --- labels ------------------------------------------------------------------------------------


@query
def kappa(spark: SparkSession, sf: str) -> DataFrame:
    return labels.kappa(labels.unpivot_ratings(fr.ratings(spark, sf), ["doc_id"], ["quality", "toxic"]))


@query
def taxonomy_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return labels.taxonomy_rollup(fr.taxonomy(spark, sf))


@query
def relation_fill(spark: SparkSession, sf: str) -> DataFrame:
    return labels.fill_relations(fr.relation_sheet(spark, sf), "row_no")


@query
def relation_counts(spark: SparkSession, sf: str) -> DataFrame:
    return labels.relation_counts(relation_fill(spark, sf), "left_label", "right_label")


@query
def size_reduction(spark: SparkSession, sf: str) -> DataFrame:
    return labels.size_reduction(fr.observed_sizes(spark, sf))


@query
def size_reduction_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return labels.reduction_percentiles(labels.size_reduction(fr.observed_sizes(spark, sf)))


@query
def size_reduction_summary(spark: SparkSession, sf: str) -> DataFrame:
    return labels.reduction_summary(labels.size_reduction(fr.observed_sizes(spark, sf)))


# --- streams -----------------------------------------------------------------------------------


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parquet*")


@query
def stream_container_findings(spark: SparkSession, sf: str) -> DataFrame:
    snaps = fr.container_snapshots(_stream(spark, sf, "events"))
    base = work_dir(spark, "watch")
    watch.watch_containers(snaps, f"{base}/out", f"{base}/checkpoint", ["event_id", "container_id"]).awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query
def stream_image_findings(spark: SparkSession, sf: str) -> DataFrame:
    snaps = snapshots.images(fr.image_captures(_stream(spark, sf, "part")))
    base = work_dir(spark, "watch-images")
    watch.watch_images(snaps, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query
def stream_finding_transitions(spark: SparkSession, sf: str) -> DataFrame:
    sets = containers.rule_sets(fr.container_snapshots(_stream(spark, sf, "events")), list(fr.CONTAINER_KEYS))
    base = work_dir(spark, "transitions")
    transitions.watch_transitions(
        sets, f"{base}/out", f"{base}/checkpoint", "container_id", ["ts", "event_id"]
    ).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("container_id", "event_id", "rule_id", "change")


@query
def chunk_reassembly(spark: SparkSession, sf: str) -> DataFrame:
    """Server-sent lines to chunks to whole texts."""
    rows = fr.chunks(fr.table(spark, sf, "conversations"))
    choice = F.struct("text", F.lit(0).alias("index"), "finish_reason")
    line = F.concat(
        F.lit("data: "), F.to_json(F.struct(F.col("id").cast("string").alias("id"), F.array(choice).alias("choices")))
    )
    parsed = snapshots.completion_chunks(rows.select("seq", line.alias("line")), ("seq",))
    return completions.reassemble(parsed).withColumn("id", F.col("id").cast("long"))


@query
def stream_chunk_reassembly(spark: SparkSession, sf: str) -> DataFrame:
    base = work_dir(spark, "completions")
    chunks = fr.chunks(_stream(spark, sf, "conversations"))
    completions.watch_completions(chunks, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return completions.latest(spark, f"{base}/out")


@query
def stream_finding_expiry(spark: SparkSession, sf: str) -> DataFrame:
    """Opened and closed findings over several micro-batches; containers that are not listed for a day have gone."""
    base = work_dir(spark, "expiry")
    events = fr.in_batches(fr.event_arrivals(spark, sf), f"{base}/in")
    sets = containers.rule_sets(fr.container_snapshots(events), list(fr.CONTAINER_KEYS))
    transitions.watch_expiring(
        sets, f"{base}/out", f"{base}/checkpoint", "container_id", "ts", ["ts", "event_id"], "24 hours", "1 hour"
    ).awaitTermination()
    return spark.read.parquet(f"{base}/out").withColumn("at", F.unix_micros("at"))


@query
def finding_expiry(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the whole table, without the events that come too late."""
    events = fr.event_arrivals(spark, sf, late=False)
    sets = containers.rule_sets(fr.container_snapshots(events), list(fr.CONTAINER_KEYS))
    return containers.transitions_with_expiry(sets, "container_id", "ts", ["ts", "event_id"], "24 hours", "1 hour").withColumn("at", F.unix_micros("at"))


@query
def stream_finding_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Findings per rule and day over several micro-batches, deliveries that come twice counted once, late ones left out."""
    base = work_dir(spark, "counts")
    events = fr.in_batches(fr.event_arrivals(spark, sf), f"{base}/in")
    found = containers.container_findings(fr.container_snapshots(events), ["event_id", "ts"])
    watch.watch_counts(found, f"{base}/out", f"{base}/checkpoint", "ts", "1 day", "1 hour", ["event_id", "rule_id"]).awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.select(F.unix_seconds("window_start").alias("day"), "rule_id", "n")


@query
def stream_completions(spark: SparkSession, sf: str) -> DataFrame:
    """Completions that finish or fall silent, over several micro-batches with late and repeated chunks."""
    base = work_dir(spark, "closing")
    chunks = fr.in_batches(fr.timed_chunks(spark, sf), f"{base}/in")
    completions.watch_closing(chunks, f"{base}/out", f"{base}/checkpoint", "ts", "60 seconds", "10 minutes").awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query
def closed_completions(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the whole table, without the chunks that come too late."""
    return completions.close_completions(fr.timed_chunks(spark, sf, late=False), "ts", "60 seconds", "10 minutes")


# --- readers -----------------------------------------------------------------------------------


def _sheet(spark: SparkSession, df: DataFrame, name: str, sep: str = ",") -> str:
    path = f"{work_dir(spark, name)}/sheet"
    df.write.csv(path, header=True, sep=sep, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


@query
def read_build_tree(spark: SparkSession, sf: str) -> DataFrame:
    """All texts written below folders, the build files among them found and read back."""
    folder = F.concat((F.col("file_id") % 16).cast("string"), F.lit("/"), F.col("file_id").cast("string"), F.lit("/"), F.col("path"))
    root = f"{work_dir(spark, 'tree')}/files"
    sinks.write_files(fr.files(spark, sf).select(folder.alias("path"), "content"), root)
    found = file_sources.read_build_files(spark, root)
    file_id = F.regexp_extract("path", r"/files/\d+/(\d+)/", 1).cast("long")
    return found.select(file_id.alias("file_id"), "file_name", "is_plausible", F.md5("content").alias("digest"))


@query
def read_log_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Logs written as files, read back by line."""
    root = f"{work_dir(spark, 'logs')}/files"
    sinks.write_files(fr.logs(spark, sf).select(F.concat(F.col("source").cast("string"), F.lit(".log")).alias("path"), "content"), root)
    lines = file_sources.read_log_lines(spark, root)
    return lines.withColumn("source", F.regexp_extract("source", r"/(\d+)\.log$", 1).cast("long"))


@query
def read_pull_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Pull requests whose bodies span lines, from CSV."""
    rows = sheets.read_pull_requests(spark, _sheet(spark, fr.pull_request_sheet(spark, sf), "prs"))
    return rows.select("project", "pnumber", "is_merged", "n_files", "n_commits", F.size("commits").alias("n_listed"), "title", "body", F.col("merged_at").isNull().alias("never_merged"))


@query
def read_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """Path patterns, a file for each project."""
    root = f"{work_dir(spark, 'patterns')}/files"
    lines = fr.patterns(spark, sf).groupBy("project").agg(F.array_join(F.collect_list("pattern"), "\n").alias("content"))
    sinks.write_files(lines.select(F.concat("project", F.lit("_Patterns.csv")).alias("path"), "content"), root)
    return sheets.read_patterns(spark, root).distinct()


@query
def read_annotations(spark: SparkSession, sf: str) -> DataFrame:
    return sheets.read_annotations(spark, _sheet(spark, fr.annotation_sheet(spark, sf), "annotations", ";"))


@query
def read_taxonomy(spark: SparkSession, sf: str) -> DataFrame:
    rows = sheets.read_taxonomy(spark, _sheet(spark, fr.taxonomy(spark, sf), "taxonomy", ";"), "bad_practice")
    return rows.withColumn("levels", F.size("levels"))


@query
def read_relations(spark: SparkSession, sf: str) -> DataFrame:
    sheet = fr.relation_sheet(spark, sf).select("left_label", "right_label", (F.col("row_no") % 7).alias("occurrences"))
    rows = sheets.read_relations(spark, _sheet(spark, sheet, "relations", ";"))
    return rows.groupBy("left_label", "right_label").agg(F.count("*").alias("n"), F.sum("occurrences").alias("occurrences"))


@query
def read_observed_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Hand-kept sizes from CSV to reductions."""
    sizes_ = sheets.read_observed_sizes(spark, _sheet(spark, fr.observed_sizes(spark, sf), "sizes"))
    return labels.size_reduction(sizes_.withColumn("repo", F.col("repo").cast("long")))


@query
def image_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Image listings from JSON lines, some of them malformed or without a tag."""
    key = F.col("p_partkey")
    tag = F.when(key % 4 == 0, F.lit("")).otherwise(F.lit(',"Tag":"v1"'))
    line = F.concat(F.lit('{"ID":"'), key.cast("string"), F.lit('","Repository":"'), "p_brand", F.lit('"'), tag, F.when(key % 10 == 3, F.lit("")).otherwise("}"))
    return snapshots.image_listing(fr.table(spark, sf, "part").select(line.alias("line"))).select("ID", "name")


@query
def image_history(spark: SparkSession, sf: str) -> DataFrame:
    """History entries of images, from lines with the newest first."""
    entry = lambda i: F.when(i % 5 == 0, F.lit("{broken")).otherwise(F.concat(F.lit('{"ID":"h'), i.cast("string"), F.lit('","Size":"'), (i * 10).cast("string"), F.lit('MB"}')))
    lines = F.array_join(F.transform(F.sequence(F.col("p_size"), F.lit(1), F.lit(-1)), entry), "\n\n")
    captures = fr.spread(fr.table(spark, sf, "part").select("p_partkey", "p_size")).select(F.col("p_partkey").alias("image_id"), lines.alias("lines"))
    return snapshots.history(captures).select("image_id", "pos", "ID", "Size")
