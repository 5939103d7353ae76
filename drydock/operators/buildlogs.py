"""Build output and build runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import top_per_key

# Marks in build output and the default time limit in seconds.
TAGGED = "Successfully tagged"
SIZE_TOKEN = r"(?:^|\s)(\S+\s+(?:MB|GB|KB))(?=\s|$)"
BUILD_TIMEOUT = 300


def size_token(line: Column) -> Column:
    """First ``<number> <unit>`` pair of words, for lines that mention MB or GB at all."""
    pair = F.nullif(F.regexp_extract(line, SIZE_TOKEN, 1), F.lit(""))
    return F.when(line.contains("MB") | line.contains("GB"), F.regexp_replace(pair, r"\s+", " "))


def extract(lines: DataFrame, order: Sequence[str], build: str = "build_id") -> DataFrame:
    """``build_id, step_count, final_size``: the size is the last one behind the last tag line.

    Counts and last positions are partial aggregates, so a build with very many lines sends one row
    per task to the shuffle.
    """
    pos = F.struct(*order)
    size, tagged = size_token(F.col("line")), F.col("line").contains(TAGGED)
    marked = lines.select(
        build,
        pos.alias("pos"),
        (F.col("line").contains("Step") & F.col("line").contains("/")).alias("is_step"),
        F.when(~tagged, size).alias("size"),
        tagged.alias("is_tag"),
    )
    found = marked.groupBy(build).agg(
        F.count_if("is_step").alias("step_count"),
        F.max(F.when(F.col("size").isNotNull(), F.struct("pos", "size"))).alias("last_size"),
        F.max(F.when(F.col("is_tag"), F.col("pos"))).alias("last_tag"),
    )
    behind = F.col("last_tag").isNull() | (F.col("last_size.pos") > F.col("last_tag"))
    return found.select(build, "step_count", F.when(behind, F.col("last_size.size")).alias("final_size"))


def tail(lines: DataFrame, order: Sequence[str], k: int = 5, build: str = "build_id") -> DataFrame:
    """The last ``k`` lines of each build, blank ones among them left out afterwards."""
    last = top_per_key(lines, [build], [F.col(c).desc() for c in order], k)
    return last.filter(F.trim("line") != "")


def outcomes(runs: DataFrame, timeout: int = BUILD_TIMEOUT) -> DataFrame:
    """One record per build run: ``success, build_seconds, error_text``.

    ``runs(build_id, return_code, seconds, stderr)``; a run that reached the limit failed by time.
    """
    timed_out = F.col("return_code").isNull() & (F.col("seconds") >= timeout)
    return runs.select(
        "build_id",
        F.coalesce(F.col("return_code") == 0, F.lit(False)).alias("success"),
        F.when(timed_out, F.lit(float(timeout))).otherwise(F.round("seconds", 2)).alias("build_seconds"),
        F.when(timed_out, F.lit(f"Build exceeded the limit of {timeout} s"))
        .when(F.col("return_code") == 0, F.lit(""))
        .otherwise(F.coalesce("stderr", F.lit("")))
        .alias("error_text"),
    )


def failed_builds(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("success")).select("build_id").distinct()


def test_status(skipped: Column, success: Column) -> Column:
    return (
        F.when(skipped, F.lit("skipped"))
        .when(success, F.lit("passed"))
        .when(~success, F.lit("failed"))
        .otherwise(F.lit("unknown"))
    )


def batch_status(results: DataFrame) -> DataFrame:
    """``results(file_id, stage_ok, test_skipped, test_success)`` with ``test_status`` and ``ok``."""
    status = test_status(F.col("test_skipped"), F.col("test_success"))
    return results.withColumn("test_status", status).withColumn(
        "ok", F.col("stage_ok") & (F.col("test_skipped") | F.coalesce("test_success", F.lit(True)))
    )


def status_rollup(results: DataFrame) -> DataFrame:
    return batch_status(results).groupBy("test_status").agg(
        F.count("*").alias("n_files"), F.bool_and("ok").alias("all_ok")
    )


def batch_ok(results: DataFrame) -> DataFrame:
    return batch_status(results).agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("all_success"))
