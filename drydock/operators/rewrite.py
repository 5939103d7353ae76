"""Static size rewrites over a corpus, one map over rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rewrites as rw
from ..functions import rules
from .lint import KEYS, with_instructions
from .rows import hold


def static_rewrite(files: DataFrame, keys: Sequence[str] = KEYS, safe_cleanup: bool = False) -> DataFrame:
    """``keys, content, rewritten, changed, n_changes, saving_kb``.

    A rewrite is applied when its rule fired somewhere in the file. ``n_changes`` is the length of
    the change log: edited lines, plus the dangling '&&' lines, which are logged once per finding of
    the clean-up rule though they stay as they are. Nothing is logged when the text did not change.
    ``safe_cleanup`` puts clean-ups at the end of whole commands instead of behind each line.
    """
    parsed = with_instructions(files, [*keys, "content"])
    found = parsed.select(
        *keys,
        "content",
        F.concat(
            F.flatten(
                F.transform("instrs", lambda x, i: rules.instruction_findings(i, x["instruction"], x["value"]))
            ),
            rules.file_findings(F.col("instrs")),
        )["rule_id"].alias("fired"),
    )
    lines = found.select(
        *keys,
        "content",
        F.split("content", "\n").alias("l0"),
        F.array_contains("fired", "apt_no_recommends").alias("flag_apt"),
        F.size(F.filter("fired", lambda r: r == "apt_clean")).alias("n_clean"),
        F.array_contains("fired", "pip_cache").alias("flag_pip"),
        F.aggregate(
            F.filter("fired", rules.is_size_related),
            F.lit(0).cast("long"),
            lambda acc, r: acc + rules.saving_kb(r),
        ).alias("kb"),
    )
    # A file whose text lacks the commands is left without walking over its lines.
    has_apt, has_pip = F.col("content").contains(rw.APT_INSTALL), F.col("content").contains(rw.PIP_INSTALL)
    apt, clean, pip = F.col("flag_apt") & has_apt, (F.col("n_clean") > 0) & has_apt, F.col("flag_pip") & has_pip
    flagged = lines.select(
        *keys,
        "content",
        "kb",
        "n_clean",
        clean.alias("clean"),
        pip.alias("pip"),
        F.when(apt, rw.count_flag_edits(F.col("l0"), rw.APT_INSTALL, rw.APT_FLAG)).otherwise(0).alias("n_apt"),
        F.when(apt, rw.add_flag(F.col("l0"), rw.APT_INSTALL, rw.APT_FLAG)).otherwise(F.col("l0")).alias("l1"),
    )
    if safe_cleanup:
        once = hold(
            flagged,
            [*keys, "content", "kb", "pip", "n_apt", "clean", "l1"],
            F.when(F.col("clean"), rw.clean_commands(rw.commands(F.array_join("l1", "\n")))).otherwise(F.array().cast("array<struct<text:string,edited:boolean>>")),
            "commands",
        )
        cleaned = once.select(
            *keys, "content", "kb", "pip", "n_apt",
            F.when(F.col("clean"), F.split(F.array_join(F.transform("commands", lambda c: c["text"]), "\n"), "\n"))
            .otherwise(F.col("l1"))
            .alias("l2"),
            F.lit(0).alias("n_dangling"),
            F.size(F.filter("commands", lambda c: c["edited"])).alias("n_cleanup"),
        )
    else:
        once = flagged.select(
            *keys, "content", "kb", "pip", "n_apt", "n_clean", "clean",
            F.when(F.col("clean"), rw.count_cleanup_hits(F.col("l1"))).otherwise(0).alias("n_cleanup"),
            F.when(F.col("clean"), F.split(F.array_join(rw.add_cleanup(F.col("l1")), "\n"), "\n"))
            .otherwise(F.col("l1"))
            .alias("l2"),
        )
        cleaned = once.select(
            *keys, "content", "kb", "pip", "n_apt", "n_cleanup", "l2",
            F.when(
                F.col("clean") & (F.col("n_clean") > 1),
                (F.col("n_clean") - 1) * rw.count_dangling_hits(F.col("l2")),
            ).otherwise(0).alias("n_dangling"),
        )
    done = cleaned.select(
        *keys,
        "content",
        "kb",
        (
            F.col("n_apt") + F.col("n_cleanup") + F.col("n_dangling")
            + F.when(F.col("pip"), rw.count_flag_edits(F.col("l2"), rw.PIP_INSTALL, rw.PIP_FLAG)).otherwise(0)
        ).alias("n"),
        F.array_join(
            F.when(F.col("pip"), rw.add_flag(F.col("l2"), rw.PIP_INSTALL, rw.PIP_FLAG)).otherwise(F.col("l2")), "\n"
        ).alias("rewritten"),
    )
    changed = F.col("rewritten") != F.col("content")
    return done.select(
        *keys,
        "content",
        "rewritten",
        changed.alias("changed"),
        F.when(changed, F.col("n")).otherwise(0).alias("n_changes"),
        F.when(changed, F.col("kb")).otherwise(0).alias("saving_kb"),
    )


def stage_texts(rewritten: DataFrame, model_text: DataFrame | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """``keys, stage, content``: the text of each stage, one row per stage that changed something."""
    stages = F.array(
        F.struct(F.lit("original").alias("stage"), F.col("content").alias("content")),
        F.when(F.col("changed"), F.struct(F.lit("static_optimized").alias("stage"), F.col("rewritten").alias("content"))),
    )
    if model_text is not None:
        rewritten = rewritten.join(model_text.select(*keys, F.col("content").alias("model")), list(keys), "left")
        base = F.when(F.col("changed"), F.col("rewritten")).otherwise(F.col("content"))
        kept = (F.col("model") != "") & (F.col("model") != base)
        stages = F.concat(
            stages, F.array(F.when(kept, F.struct(F.lit("llm_optimized").alias("stage"), F.col("model").alias("content"))))
        )
    return rewritten.select(*keys, F.explode(F.array_compact(stages)).alias("_s")).select(*keys, "_s.*")


def keep_real_rewrites(df: DataFrame, before: str, after: str) -> DataFrame:
    """Rows whose new text is neither blank nor the old text."""
    return df.filter((F.coalesce(F.col(after), F.lit("")) != "") & ~F.col(after).eqNullSafe(F.col(before)))
