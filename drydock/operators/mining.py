"""Pull requests, diffs and commits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths
from .rows import hold, unfold
from .skew import first_per_key

PR = ["project", "pnumber"]
#: Characters of the piece of a pattern by which paths find it.
GRAM = 5


def dedup_prs(prs: DataFrame, position: str = "pos") -> DataFrame:
    """The first row of each (project, number), before any other filter."""
    return first_per_key(prs, PR, [F.col(position)])


def changed_files(diffs: DataFrame) -> DataFrame:
    """``project, pnumber, path`` from diff text; one text may hold many files, one PR many texts."""
    lines = unfold(diffs, PR, F.split("diff_text", "\n"), "line").filter(F.col("line").startswith("diff --git "))
    return hold(lines, PR, paths.diff_header_path(F.col("line")), "path")


def _used(patterns: DataFrame) -> DataFrame:
    """Distinct patterns; a blank one would match every path."""
    return patterns.select("project", F.trim("pattern").alias("pattern")).filter("pattern <> ''").distinct()


def _grams(text: Column, length: Column) -> Column:
    """The different pieces of ``length`` characters of a text."""
    starts = F.sequence(F.lit(1), F.length(text) - length + 1)
    pieces = F.transform(starts, lambda i: F.substring(text, i, length))
    return F.when(F.length(text) >= length, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))


def pattern_index(patterns: DataFrame) -> DataFrame:
    """``project, pattern, gram``: of each pattern the piece that the fewest patterns of its project have.

    A pattern shorter than ``GRAM`` is its own piece.
    """
    used = _used(patterns)
    size = F.least(F.length("pattern"), F.lit(GRAM))
    pieces = used.select("project", "pattern", F.explode(_grams(F.col("pattern"), size)).alias("gram"))
    counts = pieces.groupBy("project", "gram").agg(F.count("*").alias("n"))
    rarest = pieces.join(counts, ["project", "gram"]).groupBy("project", "pattern").agg(F.min(F.struct("n", "gram")).alias("r"))
    return rarest.select("project", "pattern", F.col("r.gram").alias("gram"))


def pattern_candidates(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """``project, path, pattern``: different paths with the patterns whose rarest piece they hold.

    An equi-join of pieces, so a path meets few patterns however many its project has.
    """
    index = pattern_index(patterns)
    lengths = index.groupBy("project").agg(F.collect_set(F.length("gram")).alias("lengths"))
    held = files.select("project", "path").distinct().join(lengths, "project")
    pieces = F.flatten(F.transform("lengths", lambda n: _grams(F.col("path"), n)))
    return held.select("project", "path", F.explode(pieces).alias("gram")).join(index, ["project", "gram"]).select("project", "path", "pattern")


def pattern_paths(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """``project, path``: the different paths that contain a pattern of their project."""
    return pattern_candidates(files, patterns).filter(F.col("path").contains(F.col("pattern"))).select("project", "path").distinct()


def matching_paths(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """Counted paths that contain a pattern of their project, each (project, pnumber, path) row once."""
    counted = files.filter(paths.is_counted_path(F.col("path"))).select(*PR, "path").distinct()
    return counted.join(pattern_paths(counted, patterns), ["project", "path"], "left_semi").select(*PR, "path")


def file_evidence(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """``project, pnumber, n_changed, is_candidate``: one row per PR with at least one changed file.

    Only counted paths that are no build files look for a pattern. One shuffle of partial sums, one row per PR and task,
    whatever the size of a PR.
    """
    tagged = files.select(*PR, "path", paths.is_counted_path(F.col("path")).alias("counted"), paths.is_build_path(F.col("path")).alias("build"))
    hits = pattern_paths(tagged.filter("counted and not build"), patterns).withColumn("hit", F.lit(True))
    summed = tagged.join(hits, ["project", "path"], "left").groupBy(*PR).agg(
        F.count("*").alias("n_changed"), F.bool_or(F.col("counted") & (F.col("build") | F.coalesce("hit", F.lit(False)))).alias("is_candidate")
    )
    return summed.select(*PR, "n_changed", "is_candidate")


def select_prs(prs: DataFrame, files: DataFrame, patterns: DataFrame, position: str = "pos") -> DataFrame:
    """PRs that touch build or CI files and whose diff is complete; input columns are kept.

    De-duplication comes first: a rejected first row also rejects its later copies.
    """
    kept = dedup_prs(prs, position).filter("n_files <> 0 and n_commits <> 0")
    evidence = file_evidence(files, patterns)
    complete = (F.col("n_changed") > 0) & (F.col("n_changed") == F.col("n_files"))
    return kept.join(evidence, PR).filter(complete & F.col("is_candidate")).drop("n_changed", "is_candidate")


def relevant_repos(sheet: DataFrame) -> DataFrame:
    """Repositories marked Yes on both questions of the classification sheet."""
    return sheet.filter((F.col("uses_docker") == "Yes") & (F.col("is_cps") == "Yes")).select("repo").distinct()


def search_hits(pages: DataFrame, min_stars: int = 10) -> DataFrame:
    """Distinct repository URLs over the hits of all topics: enough stars, no forks."""
    hits = pages.select(F.explode("page.items").alias("h")).select("h.*")
    return (
        hits.filter((F.col("stargazers_count") >= min_stars) & ~F.col("fork") & F.col("html_url").isNotNull())
        .select(F.col("html_url").alias("repo_url"))
        .distinct()
    )


def container_commits(commit_files: DataFrame, repos: DataFrame | None = None, path_test: str | None = None) -> DataFrame:
    """Distinct URLs of commits that change, not add, a container file; sinks and samples sort them."""
    touched = (
        F.lower("filename").contains("docker") if path_test is None else F.col("filename").rlike(paths.CONTAINER_PATH_TESTS[path_test])
    )
    kept = commit_files.filter(touched & (F.col("change_type") != "ADD"))
    if repos is not None:
        kept = kept.join(repos.select("repo_url").distinct(), "repo_url", "left_semi")
    return kept.select(paths.commit_url(F.col("repo_url"), F.col("sha")).alias("commit_url")).distinct()


def join_commits(commit_files: DataFrame, commits: DataFrame) -> DataFrame:
    """Changed files with the columns of their commit, by repository and ``sha``; merge-only commits drop out."""
    return commit_files.join(commits, ["repo_url", "sha"])


def split_commit_urls(urls: DataFrame, column: str = "commit_url") -> DataFrame:
    return urls.select(column, paths.commit_url_parts(F.col(column)).alias("p")).select(column, "p.*")


