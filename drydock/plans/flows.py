"""Whole dataflows, composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import replies as rp
from ..operators import lint, replies, repos, rewrite, savings, scorecard


def size_run(all_repos: DataFrame, files: DataFrame, responses: DataFrame, fixes: DataFrame, parity_total: bool = False) -> DataFrame:
    """One row per repository: its preferred build file, static rewrites, size issues of the model
    reply to it, savings and the error, if any.

    ``files(repo_id, file_id, path, content)``; ``responses(file_id, raw)`` are analyses and
    ``fixes(file_id, raw)`` the files written for them. Model issues count only when the fix brought a
    text that differs from the rewritten one. The file of a repository is chosen by path, and only
    chosen files are rewritten.
    """
    build = repos.build_files(files)
    chosen = repos.preferred_file(build.select("repo_id", "file_id", "path")).select("file_id")
    rewritten = rewrite.static_rewrite(build.join(chosen, "file_id", "left_semi"), ["repo_id", "file_id"])
    static = rewritten.select(
        "repo_id", "file_id", F.col("n_changes").cast("long").alias("static_issues"), F.col("saving_kb").alias("static_kb"), "rewritten"
    )
    analysed = replies.normalise(responses, "file_id")
    issues = analysed.select(
        "file_id",
        "status",
        F.col("error").alias("model_error"),
        rp.size_issues(F.concat("data.performance_issues", "data.optimization_opportunities")).alias("issues"),
        F.col("data.estimated_wasted_space_kb").alias("wasted"),
    )
    model = issues.select(
        "file_id",
        "model_error",
        F.when(replies.succeeded(F.col("status")), F.size("issues")).otherwise(0).alias("n_issues"),
        savings.model_saving_kb(F.col("issues"), F.col("wasted")).alias("issue_kb"),
    )
    base = static.select("file_id", F.col("rewritten").alias("content"))
    fixed = replies.fixed_files(fixes, base, errors=True).select("file_id", F.col("status").alias("fix_status"), "fix_error")
    done = static.drop("rewritten").join(model, "file_id", "left").join(fixed, "file_id", "left")
    ids = all_repos.select("repo_id").distinct()
    joined = ids.join(done, "repo_id", "left")
    counted = F.coalesce((F.col("n_issues") > 0) & (F.col("fix_status") == "ok"), F.lit(False))
    missing = F.when(F.col("file_id").isNull(), F.lit("no_dockerfile"))
    no_reply = F.when(F.col("file_id").isNotNull() & F.col("n_issues").isNull(), F.lit("no reply"))
    fix_error = F.when(F.col("n_issues") > 0, F.when(F.col("fix_status").isNull(), F.lit("no fix reply")).otherwise(F.col("fix_error")))
    model_error = F.coalesce("model_error", no_reply, fix_error)
    counts = joined.select(
        "repo_id",
        "file_id",
        F.coalesce("static_issues", F.lit(0)).alias("static_issues"),
        F.coalesce("static_kb", F.lit(0)).alias("static_kb"),
        F.when(counted, F.col("n_issues")).otherwise(0).cast("long").alias("llm_issues"),
        F.when(counted, F.col("issue_kb")).otherwise(0.0).alias("llm_kb"),
        missing.alias("missing"),
        model_error.alias("model_error"),
    )
    return counts.select(
        "repo_id", "file_id", "static_issues", "static_kb", "llm_issues", "llm_kb",
        savings.total_saving(F.col("static_kb"), F.col("llm_kb"), parity_total, F.col("model_error").isNotNull()).alias("total_kb"),
        savings.joined_error(F.col("missing"), F.col("model_error")).alias("error"),
    )


def scorecard_run(files: DataFrame, before: DataFrame, fixes: DataFrame, after: DataFrame, key: str = "file_id") -> DataFrame:
    """Scorecard from raw replies: ``before`` and ``after`` are analyses, ``fixes`` rewritten files."""
    original = scorecard.score(replies.normalise(before, key))
    fixed = scorecard.score(replies.normalise(after, key))
    repaired = replies.fixed_files(fixes, files, key)
    return scorecard.scorecard(files, original, repaired, fixed, key)


def size_lint(files: DataFrame, profile: bool = False) -> DataFrame:
    """Size findings of a corpus, over all size rules or the size-only profile."""
    found = lint.findings(repos.build_files(files))
    return lint.size_profile(found) if profile else lint.size_related(found)
