"""Lines around keyword hits in logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any, text_lines
from .rows import unfold

# Default keywords and radius.
KEYWORDS = ("docker", "dockerd", "containerd", "buildkit")
RADIUS = 10
# Lines of a block that a match asks for.
BLOCK_LINES = 1024


def number_lines(logs: DataFrame, source: str = "source") -> DataFrame:
    """``source, line_no, content`` from whole log texts; line numbers count from 1."""
    rows = unfold(logs, [source], text_lines(F.col("content")), "content", pos="line_no")
    return rows.select(source, (F.col("line_no") + 1).alias("line_no"), "content")


def _hit(line: Column, keywords: Sequence[str]) -> Column:
    return contains_any(F.lower(line), [k.lower() for k in keywords])


def matches(lines: DataFrame, keywords: Sequence[str] = KEYWORDS) -> DataFrame:
    return lines.filter(_hit(F.col("content"), keywords))


def context_in_text(
    logs: DataFrame, keywords: Sequence[str] = KEYWORDS, radius: int = RADIUS, source: str = "source"
) -> DataFrame:
    """``source, match_line, line_no, marker, content`` for logs held as whole texts.

    Overlapping contexts repeat lines, once per match. The lines of a log are in one row, so the
    context is a slice of an array: no join and no shuffle.
    """
    split = logs.select(source, text_lines(F.col("content")).alias("lines"))
    low = [k.lower() for k in keywords]
    hits = F.filter(
        F.transform("lines", lambda l, i: F.when(contains_any(F.lower(l), low), i)), lambda i: i.isNotNull()
    )
    def context(hit: Column) -> Column:
        start = F.greatest(hit - radius, F.lit(0))
        return F.struct(hit.alias("hit"), start.alias("start"), F.slice("lines", start + 1, hit + radius + 1 - start).alias("near"))

    # The slices are cut before the rows are made, so no row carries the whole text.
    at = unfold(split, [source], F.transform(hits, context), "_h").select(source, "_h.*")
    around = unfold(at, [source, "hit", "start"], F.col("near"), "content", pos="k")
    line = F.col("start") + F.col("k")
    return around.select(
        source,
        (F.col("hit") + 1).alias("match_line"),
        (line + 1).alias("line_no"),
        F.when(line == F.col("hit"), F.lit("*")).otherwise(F.lit("")).alias("marker"),
        "content",
    )


def context_in_lines(
    lines: DataFrame, keywords: Sequence[str] = KEYWORDS, radius: int = RADIUS, source: str = "source"
) -> DataFrame:
    """The same for logs held as one row per line, of any length.

    Only lines in blocks near a match take part in the join on (source, line_no). The work per
    key is the matches near one line, however long the source is.
    """
    found = matches(lines, keywords).select(source, F.col("line_no").alias("match_line"))
    span = F.sequence(F.floor((F.col("match_line") - radius) / BLOCK_LINES), F.floor((F.col("match_line") + radius) / BLOCK_LINES))
    blocks = found.select(source, F.explode(span).alias("_block")).distinct()
    near = lines.withColumn("_block", F.floor(F.col("line_no") / BLOCK_LINES)).join(blocks, [source, "_block"], "left_semi")
    wanted = found.select(
        source, "match_line", F.explode(F.sequence(F.col("match_line") - radius, F.col("match_line") + radius)).alias("line_no")
    )
    return near.join(wanted, [source, "line_no"]).select(
        source,
        "match_line",
        "line_no",
        F.when(F.col("line_no") == F.col("match_line"), F.lit("*")).otherwise(F.lit("")).alias("marker"),
        "content",
    )
