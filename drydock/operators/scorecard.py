"""Before/after scorecard over two analyses of each file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scoring as sc
from .replies import succeeded
from .rows import unfold

SCORE_NAMES = ("overall", "security", "efficiency", "best_practices", "complexity", "maintainability", "wasted_kb")
IMPROVED = ("overall", "security", "efficiency", "best_practices")


def score(analyses: DataFrame, parity: bool = False) -> DataFrame:
    """Add ``scores``. They are null for failed analyses unless ``parity``."""
    value = sc.scores(F.col("data"))
    return analyses.withColumn("scores", value if parity else F.when(succeeded(F.col("status")), value))


def improvements(compared: DataFrame, key: str = "file_id") -> DataFrame:
    """``key, score_key, original, fixed, improvement, percent_change`` from columns
    ``scores`` and ``fixed_scores``."""
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("score_key"), sc.improvement(F.col(f"scores.{n}"), F.col(f"fixed_scores.{n}")).alias("i"))
            for n in sc.COMPARED_SCORES
        ]
    )
    return unfold(compared, [key], rows, "_r").select(key, "_r.score_key", "_r.i.*")


def issue_changes(compared: DataFrame, key: str = "file_id") -> DataFrame:
    """``key, section`` with counts and set differences, from columns ``data`` and ``fixed_data``."""
    rows = F.array(
        *[
            F.struct(F.lit(s).alias("section"), sc.compare_issues(F.col("data")[f], F.col("fixed_data")[f]).alias("c"))
            for s, f in sc.SECTIONS.items()
        ]
    )
    return unfold(compared, [key], rows, "_r").select(key, "_r.section", "_r.c.*")


def compare(original: DataFrame, fixed: DataFrame, key: str = "file_id") -> DataFrame:
    """Scored analyses of a file and of its fixed text side by side; the fixed one may be absent."""
    after = fixed.select(
        key,
        F.col("status").alias("fixed_status"),
        F.col("error").alias("fixed_error"),
        F.col("data").alias("fixed_data"),
        F.col("scores").alias("fixed_scores"),
    )
    return original.join(after, key, "left")


def scorecard(files: DataFrame, original: DataFrame, fixes: DataFrame, fixed: DataFrame, key: str = "file_id") -> DataFrame:
    """One row per file: identity, 7 scores before and after, 4 improvements, 6 issue counts, 3 errors.

    ``files(file_id, repo_url, path)``, ``original`` and ``fixed`` scored analyses, ``fixes(file_id,
    status)``. Stages that did not run leave nulls; a failed validation keeps the original scores.
    """
    # One join key throughout, unique on every side: one shuffle per input and no hot key.
    joined = (
        files.select(key, "repo_url", "path")
        .join(original, key, "left")
        .join(fixes.select(key, F.col("status").alias("fix_status")), key, "left")
    )
    joined = compare(joined, fixed, key)
    analysed = F.coalesce(succeeded(F.col("status")), F.lit(False))
    repaired = analysed & F.coalesce(F.col("fix_status") == "ok", F.lit(False))
    validated = repaired & F.coalesce(succeeded(F.col("fixed_status")), F.lit(False))
    staged = joined.select(
        "*",
        repaired.alias("repaired"),
        validated.alias("validated"),
        F.when(validated, F.col("fixed_scores")).when(repaired, F.col("scores")).alias("after"),
        *[
            F.when(validated, sc.compare_issues(F.col("data")[f], F.col("fixed_data")[f])).alias(f"cmp_{s}")
            for s, f in sc.SECTIONS.items()
        ],
    )
    analysis_failed = F.when(F.col("path").isNull(), F.lit("No build file found")).when(
        ~analysed, F.coalesce("error", F.lit("The analysis failed"))
    )
    return staged.select(
        key,
        "repo_url",
        F.coalesce("path", F.lit("")).alias("path"),
        *[F.col(f"scores.{n}").alias(f"original_{n}") for n in SCORE_NAMES],
        *[F.col(f"after.{n}").alias(f"fixed_{n}") for n in SCORE_NAMES],
        *[
            F.when(F.col("validated"), sc.improvement(F.col(f"scores.{n}"), F.col(f"after.{n}"))["improvement"]).alias(
                f"improvement_{n}"
            )
            for n in IMPROVED
        ],
        *[
            F.col(f"cmp_{s}.{c}").alias(f"{s}_{when}")
            for s in sc.SECTIONS
            for c, when in (("original_count", "before"), ("fixed_count", "after"))
        ],
        analysis_failed.alias("llm_error"),
        F.when(analysed & ~F.col("repaired"), F.lit("No new build file in the reply")).alias("fix_error"),
        F.when(F.col("repaired") & ~F.col("validated"), F.coalesce("fixed_error", F.lit("The validation failed"))).alias(
            "validation_error"
        ),
    )


def stage_success(card: DataFrame, key: str = "file_id") -> DataFrame:
    """``key, success``: the analysis and the fix both worked."""
    return card.select(key, (F.col("llm_error").isNull() & F.col("fix_error").isNull()).alias("success"))


def run_metadata(card: DataFrame) -> DataFrame:
    """One row: run time, distinct repositories, files. Repositories are folded before counting."""
    per_repo = card.groupBy("repo_url").agg(F.count("*").alias("n"))
    return per_repo.agg(F.count("*").alias("repo_count"), F.coalesce(F.sum("n"), F.lit(0)).alias("dockerfile_count")).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("run_timestamp"),
        "repo_count",
        "dockerfile_count",
    )
