"""Scores of one analysis, and the before/after comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Points per issue, weights of the overall score, compared keys and sections.
POINTS = {"security": ("security_risks", 12), "efficiency": ("performance_issues", 9), "best_practices": ("best_practices_missing", 12)}
WEIGHTS = {"security": 0.3, "efficiency": 0.4, "best_practices": 0.3}
COMPARED_SCORES = ("overall", "security", "efficiency", "best_practices", "complexity", "maintainability")
SECTIONS = {
    "security_risks": "security_risks",
    "performance_issues": "performance_issues",
    "missing_practices": "best_practices_missing",
}


def scores(analysis: Column) -> Column:
    """``struct`` of seven scores from a normalised analysis struct."""
    part = {
        name: F.greatest(F.lit(0), F.lit(100) - F.size(analysis[field]) * points).cast("double")
        for name, (field, points) in POINTS.items()
    }
    overall = sum((part[name] * weight for name, weight in WEIGHTS.items()), F.lit(0.0))
    return F.struct(
        F.round(overall, 1).alias("overall"),
        *[part[name].alias(name) for name in POINTS],
        F.round(F.coalesce(analysis["complexity_score"], F.lit(5.0)), 1).alias("complexity"),
        F.round(F.coalesce(analysis["maintainability_score"], F.lit(5.0)), 1).alias("maintainability"),
        F.round(F.coalesce(analysis["estimated_wasted_space_kb"], F.lit(0.0)), 2).alias("wasted_kb"),
    )


def improvement(original: Column, fixed: Column) -> Column:
    """``struct<original, fixed, improvement, percent_change>``; percent is 0 for originals <= 0."""
    before, after = F.coalesce(original, F.lit(0.0)), F.coalesce(fixed, F.lit(0.0))
    percent = F.when(before > 0, (after - before) / before * 100).otherwise(0.0)
    return F.struct(
        F.round(before, 1).alias("original"),
        F.round(after, 1).alias("fixed"),
        F.round(after - before, 1).alias("improvement"),
        F.round(percent, 1).alias("percent_change"),
    )


def compare_issues(original: Column, fixed: Column) -> Column:
    """Counts and set differences of two issue lists, duplicates ignored."""
    before, after = F.array_distinct(original), F.array_distinct(fixed)
    n_before, n_after = F.size(before), F.size(after)
    return F.struct(
        n_before.alias("original_count"),
        n_after.alias("fixed_count"),
        F.array_except(before, after).alias("fixed"),
        F.array_except(after, before).alias("new"),
        F.array_intersect(after, before).alias("remaining"),
        F.greatest(F.lit(0), n_before - n_after).alias("n_resolved"),
        ((n_before > 0) & (n_after == 0)).alias("all_resolved"),
    )
