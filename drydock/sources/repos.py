"""Repository and commit lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.skew import running
from .csvfiles import header_of, read_csv


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path, line_no, line`` of text files, numbered from 0 in file order; files are read in splits."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
        F.col("value").alias("line"),
        F.lit(1).alias("_one"),
    )
    numbered = running(lines, ["path"], ["_start", "_row"], "_one", total="line_no")
    return numbered.select("path", (F.col("line_no") - 1).cast("int").alias("line_no"), "line")


def repo_urls(lines: DataFrame) -> DataFrame:
    """URLs of ``lines(line_no, line)``: blanks and '#' lines dropped, comma lists split, parts
    without ``http`` dropped. ``part`` keeps the order inside a line."""
    text = lines.select(*[c for c in lines.columns if c != "line"], strip(F.col("line")).alias("line"))
    kept = text.filter((F.col("line") != "") & ~F.col("line").startswith("#"))
    parts = kept.select(
        *[c for c in kept.columns if c != "line"], F.posexplode(F.split("line", ",")).alias("part", "url")
    )
    return parts.withColumn("url", strip(F.col("url"))).filter(F.col("url").contains("http"))


def plain_repo_urls(lines: DataFrame) -> DataFrame:
    """The simple variant: one URL per line; the comment test looks at the untrimmed line."""
    kept = lines.filter((strip(F.col("line")) != "") & ~F.col("line").startswith("#"))
    return kept.select(*[c for c in lines.columns if c != "line"], strip(F.col("line")).alias("url"))


def limited(urls: DataFrame, n: int, order: Sequence[str] = ("line_no",)) -> DataFrame:
    """The first ``n`` URLs in list order."""
    return urls.orderBy(*order).limit(n)


def first_repo_url(lines: DataFrame) -> DataFrame:
    """The first line that is a URL, as at most one row."""
    urls = plain_repo_urls(lines).filter(F.col("url").startswith("http") & ~F.col("url").startswith("#"))
    return urls.orderBy("line_no").limit(1)


def repo_sheet(rows: DataFrame, limit: int | None = None, position: str | None = None) -> DataFrame:
    """``url`` from a sheet's Repository column, else Repo; rows without one do not count.

    A ``limit`` takes the first rows by ``position``, which it needs.
    """
    if limit is not None and position is None:
        raise ValueError("a limit needs a position")
    names = [c for c in ("Repository", "Repo") if c in rows.columns]
    url = F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in names])
    kept = rows.withColumn("url", url).filter("url is not null")
    if limit is None:
        return kept
    return kept.orderBy(position).limit(limit)


def read_repo_sheet(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """The rows of a sheet with its header's columns, in the order of the sheet; ``limit`` takes the first ones."""
    schema = ", ".join(f"`{name}` string" for name in header_of(spark, path))
    return repo_sheet(read_csv(spark, path, schema), limit, "pos").orderBy("pos").drop("pos")


def classified_repos(rows: DataFrame) -> DataFrame:
    """``id, repo, uses_docker, is_cps`` of the classification sheet; section rows have no number."""
    return rows.select(
        F.trim("Id").try_cast("int").alias("id"),
        F.col("Repo").alias("repo"),
        F.col("`Uses Docker ?`").alias("uses_docker"),
        F.col("`Is CPS related/specific`").alias("is_cps"),
    ).filter("id is not null")


def commit_urls(lines: DataFrame) -> DataFrame:
    return lines.select(F.trim("line").alias("commit_url")).filter("commit_url <> ''")
