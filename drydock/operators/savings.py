"""Estimated savings and the result tables of the size run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from .lint import with_findings
from .rows import hold

STAGES = ("original", "static_optimized", "llm_optimized")


def file_savings(found: DataFrame, keys: Sequence[str] = ("file_id",)) -> DataFrame:
    """``keys, n_size_findings, saving_kb`` over the size-related findings."""
    return (
        found.filter(rules.is_size_related(F.col("rule_id")))
        .groupBy(*keys)
        .agg(F.count("*").alias("n_size_findings"), F.sum(rules.saving_kb(F.col("rule_id")).cast("long")).alias("saving_kb"))
    )


def savings_in_row(files: DataFrame, keys: Sequence[str] = ("file_id",)) -> DataFrame:
    """The same from files, one row per file with at least one size finding, without a shuffle."""
    ids = F.filter(F.col("findings")["rule_id"], rules.is_size_related)
    per_file = with_findings(files, keys).select(*keys, ids.alias("ids"))
    total = F.aggregate("ids", F.lit(0).cast("long"), lambda acc, r: acc + rules.saving_kb(r))
    summed = F.struct(F.size("ids").cast("long").alias("n_size_findings"), total.alias("saving_kb"))
    return hold(per_file, keys, F.when(F.size("ids") > 0, summed), "_s").select(*keys, "_s.*")


def top_files(savings: DataFrame, k: int = 20, key: str = "file_id") -> DataFrame:
    return savings.orderBy(F.desc("saving_kb"), F.col(key)).limit(k)


def total_saving(static_kb: Column, model_kb: Column, parity: bool = False, model_failed: Column | None = None) -> Column:
    """Static plus model savings. ``parity`` keeps the total at 0 when the model stage failed."""
    total = F.coalesce(static_kb, F.lit(0)) + F.coalesce(model_kb, F.lit(0))
    if not parity:
        return total
    return F.when(model_failed, F.lit(0)).otherwise(total)


def model_saving_kb(issues: Column, wasted_kb: Column) -> Column:
    """Saving of size issues by the first matching word group, plus a positive waste estimate."""

    def one(text: Column) -> Column:
        low = F.lower(text)
        return (
            F.when(low.contains("--no-install-recommends"), 50000)
            .when(low.contains("cache") | low.contains("clean"), 10000)
            .when(low.contains("multi-stage"), 100000)
            .when(low.contains("layer"), 20000)
            .otherwise(0)
        )

    per_issue = F.aggregate(issues, F.lit(0).cast("double"), lambda acc, t: acc + one(t))
    return per_issue + F.greatest(F.coalesce(wasted_kb, F.lit(0.0)), F.lit(0.0))


def stage_sizes(builds: DataFrame, images_built: bool = True) -> DataFrame:
    """``repo_id, original_size, static_size, llm_size``: sizes or sentinels, one row per repository.

    ``builds(repo_id, stage, image_size, build_success)`` has one row per stage that made a file;
    a stage without a row changed nothing.
    """

    def cell(stage: str, absent: str) -> Column:
        is_stage = F.col("stage") == stage
        size = F.max(F.when(is_stage, F.nullif("image_size", F.lit(""))))
        present = F.coalesce(F.bool_or(is_stage), F.lit(False))
        built = F.coalesce(F.bool_or(is_stage & F.col("build_success")), F.lit(False))
        no_size = F.when(F.lit(images_built) & ~built, F.lit("BUILD_FAILED")).otherwise(F.lit("N/A"))
        return F.when(present, F.coalesce(size, no_size)).otherwise(F.lit(absent))

    lost = "BUILD_FAILED" if images_built else "N/A"
    return builds.groupBy("repo_id").agg(
        cell("original", lost).alias("original_size"),
        cell("static_optimized", "NO_OPTIMIZATIONS").alias("static_size"),
        cell("llm_optimized", "NO_OPTIMIZATIONS").alias("llm_size"),
    )


def joined_error(first: Column, model: Column) -> Column:
    """``a; LLM: b`` when both are set, else the one that is."""
    return F.when(
        first.isNotNull() & model.isNotNull(), F.concat(first, F.lit("; LLM: "), model)
    ).otherwise(F.coalesce(first, model))


def run_summary(results: DataFrame) -> DataFrame:
    """One row over ``results(repo_id, error, static_issues, llm_issues, total_kb)``."""
    per_repo = results.groupBy("repo_id").agg(
        F.count_if(F.col("error").isNull()).alias("ok"),
        F.sum("static_issues").alias("static_issues"),
        F.sum("llm_issues").alias("llm_issues"),
        F.sum("total_kb").alias("total_kb"),
    )
    return per_repo.agg(
        F.count("*").alias("n_repos"),
        F.coalesce(F.sum("ok"), F.lit(0)).alias("n_files"),
        F.coalesce(F.sum("static_issues"), F.lit(0)).alias("static_changes"),
        F.coalesce(F.sum("llm_issues"), F.lit(0)).alias("llm_changes"),
        F.coalesce(F.sum("total_kb"), F.lit(0)).alias("saving_kb"),
        F.round(F.coalesce(F.sum("total_kb"), F.lit(0)) / 1024, 1).alias("saving_mb"),
    )
