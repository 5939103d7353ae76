"""Corpus lint: files -> instructions -> findings.

``files`` needs ``content`` and the columns named in ``keys``. Everything up to the findings is a
map over rows; only the counts shuffle, and those after partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import buildfile, rules
from .rows import unfold

KEYS = ("file_id",)


def logical_lines(files: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per file with its logical lines ``lines``; null where ``content`` is null."""
    kept = files.select(*keys, buildfile.kept_lines(F.col("content")).alias("kept"))
    glued = kept.select(
        *keys, buildfile.has_directive(F.col("kept")).alias("directives"), buildfile.glued_lines(F.col("kept")).alias("glued")
    )
    return glued.select(*keys, buildfile.finished_lines(F.col("glued"), F.col("directives")).alias("lines"))


def with_instructions(files: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per file with its instruction array ``instrs``; null where ``content`` is null."""
    return logical_lines(files, keys).select(*keys, buildfile.instructions(F.col("lines")).alias("instrs"))


def instructions(files: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``keys, idx, instruction, value``; idx counts from 0 within the file."""
    lines = unfold(logical_lines(files, keys), keys, F.col("lines"), "line", pos="idx")
    return lines.select(*keys, "idx", buildfile.as_instruction(F.col("line")).alias("i")).select(
        *keys, "idx", "i.instruction", "i.value"
    )


def findings(files: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``keys, idx, rule_id, severity``; idx is -1 for rules about the whole file.

    A row whose ``content`` is null stands for an unreadable file and gives ``missing_file``.
    The whole-file rules ride on the last instruction row, so the file is exploded once.
    """
    parsed = with_instructions(files, keys)
    flagged = parsed.select(
        *keys,
        "instrs",
        (F.size("instrs") - 1).alias("last"),
        F.when(F.col("instrs").isNull(), F.array(rules.finding("missing_file", F.lit(-1))))
        .otherwise(rules.file_findings(F.col("instrs")))
        .alias("whole"),
    )
    rows = flagged.select(*keys, "last", "whole", F.posexplode_outer("instrs").alias("idx", "i"))
    own = rules.instruction_findings(F.col("idx"), F.col("i.instruction"), F.col("i.value"))
    # Null on all but the last row, so the rules of the row stand once in the expression.
    whole = F.when(F.col("idx").isNull() | (F.col("idx") == F.col("last")), F.col("whole"))
    own = F.when(F.col("idx").isNotNull(), own)
    found = F.flatten(F.array_compact(F.array(own, whole)))
    return unfold(rows, keys, found, "_f").select(*keys, "_f.*")


def with_findings(files: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per file with its ``findings`` array, for work that stays per file."""
    parsed = with_instructions(files, keys)
    own = F.flatten(
        F.transform("instrs", lambda x, i: rules.instruction_findings(i, x["instruction"], x["value"]))
    )
    return parsed.select(
        *keys,
        F.when(F.col("instrs").isNull(), F.array(rules.finding("missing_file", F.lit(-1))))
        .otherwise(F.concat(own, rules.file_findings(F.col("instrs"))))
        .alias("findings"),
    )


def size_related(found: DataFrame) -> DataFrame:
    return found.filter(rules.is_size_related(F.col("rule_id")))


def size_profile(found: DataFrame) -> DataFrame:
    """Findings of the five rules of the size-only profile."""
    return found.filter(rules.in_size_profile(F.col("rule_id")))


def review_profile(found: DataFrame) -> DataFrame:
    """Findings of the rules of the size review."""
    return found.filter(rules.in_review_profile(F.col("rule_id")))


def counts(found: DataFrame, key: str = "file_id") -> DataFrame:
    """Findings and files per rule. Counting per (rule, file) first keeps the distinct count a
    plain two-level sum, so a rule that fires everywhere is never gathered in one task."""
    per_file = found.groupBy("rule_id", "severity", key).agg(F.count("*").alias("n"))
    return per_file.groupBy("rule_id", "severity").agg(
        F.sum("n").alias("n_findings"), F.count("*").alias("n_files")
    )


def counts_in_row(files: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The same from files: rules are counted inside a file's row, so one shuffle of partial sums is left."""
    per_file = with_findings(files, keys).select(
        F.transform("findings", lambda f: F.struct(f["rule_id"].alias("rule_id"), f["severity"].alias("severity"))).alias("found")
    )
    counted = F.transform(
        F.array_distinct("found"),
        lambda r: F.struct(r["rule_id"].alias("rule_id"), r["severity"].alias("severity"), F.size(F.filter("found", lambda f: f == r)).alias("n")),
    )
    rows = unfold(per_file, [], counted, "_c").select("_c.*")
    return rows.groupBy("rule_id", "severity").agg(F.sum("n").alias("n_findings"), F.count("*").alias("n_files"))


def location(idx: Column) -> Column:
    return F.when(idx >= 0, F.concat(F.lit("instruction "), idx.cast("string"))).otherwise(F.lit("(general)"))


def rule_table(spark: SparkSession) -> DataFrame:
    """The catalogue as a table; its size is fixed by the code, so it may be broadcast."""
    rows = [
        (r.rule_id, r.target, r.severity, rules.SEVERITY_RANK[r.severity], r.size_related, r.saving_kb, r.size_profile, r.message)
        for r in rules.RULES
    ]
    return spark.createDataFrame(
        rows,
        "rule_id string, target string, severity string, severity_rank int, size_related boolean, "
        "saving_kb long, size_profile boolean, message string",
    )
