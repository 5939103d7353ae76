"""Repositories and their build files: selection, joins, incremental skip, sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import buildfile, paths
from .skew import first_per_key


def build_files(files: DataFrame) -> DataFrame:
    """Rows of ``files(path, ...)`` whose base name is a build-file name, with ``file_name``."""
    return files.withColumn("file_name", paths.file_name(F.col("path"))).filter(
        buildfile.is_buildfile_name(F.col("file_name"))
    )


def first_file(files: DataFrame, repo: str = "repo_id") -> DataFrame:
    """The first build file of each repository, by path."""
    return first_per_key(files, [repo], [F.col("path")])


def preferred_file(files: DataFrame, repo: str = "repo_id") -> DataFrame:
    """The build file named exactly ``dockerfile`` if there is one, else the first by path."""
    exact = F.lower(paths.file_name(F.col("path"))) == "dockerfile"
    return first_per_key(files, [repo], [exact.desc(), F.col("path")])


def with_missing(repos: DataFrame, files: DataFrame, repo: str = "repo_id", columns: Sequence[str] = ("path",)) -> DataFrame:
    """Every build file with ``status`` ok, and one row per repository without any.

    A left join as the union of the rows that match and the keys that do not: both are joins that
    adaptive execution splits when a key is hot.
    """
    repos = repos.select(repo).distinct()
    kept = files.select(repo, *columns)
    found = kept.join(repos, repo, "left_semi").withColumn("status", F.lit("ok"))
    empty = repos.join(files.select(repo).distinct(), repo, "left_anti").withColumn("status", F.lit("no_dockerfile"))
    return found.unionByName(empty, allowMissingColumns=True)


def fresh_only(work: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key has not been processed yet."""
    return work.join(done.select(*on).distinct(), list(on), "left_anti")


def content_key(content: Column) -> Column:
    return F.sha2(content, 256)


def nth(df: DataFrame, position: Column, k: int) -> DataFrame:
    """The k-th row (1-based) by ``position``; empty when there are fewer rows."""
    if k < 1:
        raise ValueError("k counts from 1")
    return df.orderBy(position).offset(k - 1).limit(1)


def hash_sample(df: DataFrame, key: Column, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows drawn uniformly without replacement, the same ones for the same seed."""
    return ranked_sample(df, F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), n)


def ranked_sample(df: DataFrame, rank: Column, n: int) -> DataFrame:
    """As ``hash_sample`` with the caller's own uniform rank."""
    return df.orderBy(rank).limit(n)
