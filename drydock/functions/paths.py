"""Repository URLs, commit URLs and changed paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import last_segment

# Path endings and folders that never count, and those that always do.
IGNORED_ENDINGS = (".txt", ".md", ".png", "jpeg", ".in")
IGNORED_FOLDERS = ("/docs/", "/doc/", "/Documentation/")
BUILD_ENDINGS = (".sh", ".bash", ".yml", ".yaml", ".cmake", ".config")
BUILD_NAMES = ("Jenkinsfile", "Makefile", "Dockerfile", "Vagrantfile")
# Path tests kept as options for commit mining, all case-insensitive.
CONTAINER_PATH_TESTS = {
    "container_files": r"(?i)(Dockerfile|\.dockerignore|docker[-_.\w]*)",
    "container_and_deploy_files": r"(?i)(Dockerfile|docker-compose\.yml|\.ya?ml$|\.helm$)",
}


def repo_name(url: Column, tree_aware: bool = True) -> Column:
    """Last URL segment without ``.git``; for ``.../owner/repo/tree/branch`` the repository."""
    trimmed = F.rtrim(url, F.lit("/"))
    parts = F.split(trimmed, "/")
    name = F.element_at(parts, -1)
    if tree_aware:
        name = F.when((F.size(parts) > 5) & (F.get(parts, F.lit(5)) == "tree"), F.get(parts, F.lit(4))).otherwise(name)
    return F.replace(name, F.lit(".git"), F.lit(""))


def commit_url(repo_url: Column, sha: Column) -> Column:
    owner_repo = F.concat_ws("/", F.slice(F.split(repo_url, "/"), -2, 2))
    return F.concat(F.lit("https://github.com/"), owner_repo, F.lit("/commit/"), sha)


def commit_url_parts(url: Column) -> Column:
    parts = F.split(F.trim(url), "/")
    return F.struct(
        F.get(parts, F.lit(3)).alias("owner"),
        F.get(parts, F.lit(4)).alias("repo"),
        F.element_at(parts, -1).alias("sha"),
    )


def variant_key(repo: Column, file_name: Column, stage: Column) -> Column:
    return F.concat_ws("_", repo, file_name, stage)


def diff_header_path(line: Column) -> Column:
    """New path of a ``diff --git a/x b/y`` line of exactly four words, else null."""
    return F.nullif(F.regexp_extract(line, r"(?U)^diff --git \s*\S+\s+(?:b/)?(\S+)\s*$", 1), F.lit(""))


def is_counted_path(path: Column) -> Column:
    skip = F.lit(False)
    for ending in IGNORED_ENDINGS:
        skip = skip | path.endswith(ending)
    for folder in IGNORED_FOLDERS:
        skip = skip | path.contains(folder)
    return ~skip


def is_build_path(path: Column) -> Column:
    hit = F.lit(False)
    for ending in BUILD_ENDINGS:
        hit = hit | path.endswith(ending)
    for name in BUILD_NAMES:
        hit = hit | path.contains(name)
    return hit


def file_name(path: Column) -> Column:
    return last_segment(path)
