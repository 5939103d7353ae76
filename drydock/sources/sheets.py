"""CSV sheets: pull requests, path patterns, annotations, taxonomies, relations, sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .csvfiles import read_csv


def _texts(names: list[str]) -> str:
    return ", ".join(f"`{n}` string" for n in names)


def read_pull_requests(spark: SparkSession, path: str) -> DataFrame:
    """Pull requests with typed columns; bodies may span lines. ``pos`` is the order in the file, which is read in splits."""
    return read_csv(spark, path, schemas.PULL_REQUEST).transform(typed_pull_requests)


def typed_pull_requests(rows: DataFrame) -> DataFrame:
    time = lambda c: F.try_to_timestamp(F.when(F.lower(c) != "none", F.col(c)))
    return rows.select(
        F.col("Project").alias("project"),
        F.col("PNumber").alias("pnumber"),
        time("CreatedAt").alias("created_at"),
        time("ClosedAt").alias("closed_at"),
        (F.lower("isMerged") == "true").alias("is_merged"),
        time("MergedAt").alias("merged_at"),
        F.col("MergedCommit").alias("merged_commit"),
        F.col("nFiles").alias("n_files"),
        F.col("nCommits").alias("n_commits"),
        F.filter(F.split("Commits", " "), lambda c: c != "").alias("commits"),
        F.col("Labels").alias("labels"),
        F.col("Title").alias("title"),
        F.col("Body").alias("body"),
        "pos",
    )


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    """``project, pattern``: one substring per line; the project is the file name before Patterns."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("name"), F.trim("value").alias("pattern"))
    return lines.select(F.regexp_extract("name", r"^(.*?)[-_]Patterns", 1).alias("project"), "pattern").filter("pattern <> ''")


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Two-rater sheet: project, number, then two columns per question (``<question>_1``, ``_2``)."""
    names = ["project", "pnumber"] + [f"{q}_{r}" for q in schemas.ANNOTATION_QUESTIONS for r in (1, 2)]
    return read_csv(spark, path, _texts(names), ";").select(*names)


def read_taxonomy(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """``kind, label, levels, freq, is_new``."""
    rows = read_csv(spark, path, _texts(["label", "freq", "is_new"]), ";")
    return rows.select(
        F.lit(kind).alias("kind"), "label", F.split("label", "_").alias("levels"), F.col("freq").try_cast("int").alias("freq"), "is_new"
    )


def read_relations(spark: SparkSession, path: str) -> DataFrame:
    """``row_no, left_label, right_label, occurrences`` in sheet order, left labels still blank; ``row_no`` rises along a file."""
    rows = read_csv(spark, path, _texts(["left_label", "right_label", "occurrences"]), ";")
    label = lambda n: F.coalesce(n, F.lit("")).alias(n)
    return rows.select(F.col("pos").alias("row_no"), label("left_label"), label("right_label"), F.col("occurrences").try_cast("int").alias("occurrences"))


def read_observed_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``repo, before, static, final`` as text."""
    return read_csv(spark, path, _texts(["repo", "before", "static", "final"])).drop("pos")
