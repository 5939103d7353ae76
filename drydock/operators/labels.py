"""Annotation sheets: agreement, taxonomies, relations, observed sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sizes
from .skew import forward_fill, quantiles

NO_SIZE = ("BUILD_FAILED", "NO_OPTIMIZATIONS", "N/A")


def unpivot_ratings(sheet: DataFrame, keys: Sequence[str], questions: Sequence[str]) -> DataFrame:
    """``keys, question, rater1, rater2`` from two columns per question (``q_1``, ``q_2``)."""
    answers = F.array(
        *[F.struct(F.lit(q).alias("question"), F.col(f"{q}_1").alias("rater1"), F.col(f"{q}_2").alias("rater2")) for q in questions]
    )
    return sheet.select(*keys, F.explode(answers).alias("a")).select(*keys, "a.*")


def kappa(ratings: DataFrame, by: Sequence[str] = ("question",)) -> DataFrame:
    """Observed and expected agreement and Cohen's kappa per group of ``by``.

    The ratings are folded to a contingency table first; its size is that of the label set.
    """
    by = list(by)
    table = ratings.filter("rater1 is not null and rater2 is not null").groupBy(*by, "rater1", "rater2").agg(
        F.count("*").alias("n")
    )
    total = table.groupBy(*by).agg(
        F.sum("n").alias("n_items"), F.sum(F.when(F.col("rater1") == F.col("rater2"), F.col("n")).otherwise(0)).alias("n_agree")
    )
    one = table.groupBy(*by, F.col("rater1").alias("label")).agg(F.sum("n").alias("n1"))
    two = table.groupBy(*by, F.col("rater2").alias("label")).agg(F.sum("n").alias("n2"))
    chance = one.join(two, [*by, "label"]).groupBy(*by).agg(
        F.sum(F.col("n1").cast("double") * F.col("n2")).alias("chance")
    )
    joined = total.join(chance, by, "left")
    observed = F.col("n_agree") / F.col("n_items")
    expected = F.coalesce("chance", F.lit(0.0)) / (F.col("n_items").cast("double") * F.col("n_items"))
    return joined.select(
        *by,
        "n_items",
        F.round(observed, 6).alias("observed"),
        F.round(expected, 6).alias("expected"),
        F.round(F.try_divide(observed - expected, 1 - expected), 6).alias("kappa"),
    )


def taxonomy_rollup(taxonomy: DataFrame) -> DataFrame:
    """Frequencies and new labels per first level and per first two levels of ``a_b_c`` labels."""
    parts = F.split("label", "_")
    leveled = taxonomy.select(
        F.get(parts, F.lit(0)).alias("level1"),
        F.coalesce(F.get(parts, F.lit(1)), F.lit("-")).alias("level2"),
        "freq",
        (F.col("is_new") == "YES").alias("new"),
    )
    summed = leveled.rollup("level1", "level2").agg(
        F.sum("freq").alias("freq"),
        F.count("*").alias("n_labels"),
        F.count_if("new").alias("n_new"),
        F.grouping_id().cast("int").alias("level"),
    )
    return summed.select(
        F.coalesce("level1", F.lit("(all)")).alias("level1"),
        F.coalesce("level2", F.lit("(all)")).alias("level2"),
        (F.lit(2) - F.when(F.col("level") == 3, 2).otherwise(F.col("level"))).alias("depth"),
        "freq",
        "n_labels",
        "n_new",
    )


def relation_counts(pairs: DataFrame, left: str, right: str) -> DataFrame:
    return pairs.groupBy(left, right).agg(F.count("*").alias("occurrences"))


def fill_relations(sheet: DataFrame, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """Edge list of a relation sheet whose blank left label means the label above."""
    return forward_fill(sheet, list(keys), [order], "left_label")


def observed_bytes(text: Column) -> Column:
    return sizes.parse_size(text)["bytes"]


def size_status(text: Column) -> Column:
    """``measured``, one of the in-band sentinels in lower case, or ``unknown``."""
    return (
        F.when(observed_bytes(text).isNotNull(), F.lit("measured"))
        .when(F.upper(F.trim(text)).isin(*NO_SIZE), F.lower(F.trim(text)))
        .otherwise(F.lit("unknown"))
    )


def size_reduction(observed: DataFrame) -> DataFrame:
    """``repo, before_bytes, static_bytes, final_bytes, statuses, final_ratio, saved_bytes``.

    An image without a size of its own stands for the one before it (nothing was changed).
    """
    parsed = observed.select(
        "repo",
        observed_bytes(F.col("before")).alias("before_bytes"),
        observed_bytes(F.col("static")).alias("static_bytes"),
        observed_bytes(F.col("final")).alias("final_bytes"),
        size_status(F.col("static")).alias("static_status"),
        size_status(F.col("final")).alias("final_status"),
    )
    best = F.coalesce("final_bytes", "static_bytes", "before_bytes")
    return parsed.withColumn("saved_bytes", F.col("before_bytes") - best).withColumn(
        "ratio", F.round(F.try_divide(best, F.col("before_bytes")), 4)
    )


def reduction_percentiles(reduced: DataFrame, shares: Sequence[float] = (0.1, 0.5, 0.9)) -> DataFrame:
    """Percentiles of the size ratio, interpolated, over the images that have one."""
    return quantiles(reduced, "ratio", {f"ratio_p{round(100 * s):02d}": s for s in shares})


def reduction_summary(reduced: DataFrame) -> DataFrame:
    return reduced.agg(
        F.count("*").alias("n_images"),
        F.count("before_bytes").alias("n_measured"),
        F.sum("saved_bytes").alias("saved_bytes"),
        F.count_if(F.col("saved_bytes") < 0).alias("n_grown"),
        F.count_if(F.col("saved_bytes") > 0).alias("n_shrunk"),
    )
