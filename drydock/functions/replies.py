"""Model replies: clean-up, parsing with defaults, salvage, build-file extraction, error classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import contains_any, count_of, let, strip

# The reply fields and their defaults.
LIST_FIELDS = (
    "security_risks",
    "performance_issues",
    "optimization_opportunities",
    "runtime_concerns",
    "best_practices_missing",
)
NUMBER_DEFAULTS = {"estimated_wasted_space_kb": 0.0, "complexity_score": 5.0, "maintainability_score": 5.0}
SALVAGE_FIELDS = ("security_risks", "performance_issues")
ERROR_PREFIXES = ("LLM API error:", "Error:")
RECOMMENDATION = "array<struct<category:string,severity:string,message:string,instruction_line:int>>"
# Words that mark an issue text as being about image size (lower-case search, as listed).
SIZE_WORDS = (
    "size", "layer", "cache", "no-cache", "multi-stage",
    "apt-get clean", "rm -rf /var/lib/apt/lists",
    "--no-install-recommends", "--no-cache-dir", "COPY", "ADD",
    "reduce", "smaller", "minimize", "compress",
)
# The shorter list of the size review.
REVIEW_WORDS = (
    "size", "layer", "cache", "no-cache", "multi-stage",
    "apt-get clean", "rm -rf /var/lib/apt/lists", "--no-install-recommends", "--no-cache-dir",
)
FENCE = "```"
# Words of a build file without a FROM line.
FALLBACK_WORDS = ("FROM", "RUN", "COPY", "ADD", "WORKDIR")


def is_api_error(raw: Column) -> Column:
    return raw.startswith(ERROR_PREFIXES[0]) | raw.startswith(ERROR_PREFIXES[1])


def unfenced(raw: Column) -> Column:
    """Text of the first closed code fence, a ``json`` fence first; otherwise the stripped reply."""

    def body(text: Column, opening: str) -> Column:
        after = F.substring(text, F.instr(text, opening) + F.lit(len(opening)), F.length(text))
        return let(
            after, lambda t: F.when(t.contains(FENCE), strip(F.substring_index(t, FENCE, 1))).otherwise(text)
        )

    return let(
        strip(raw),
        lambda text: F.when(text.contains(FENCE + "json"), body(text, FENCE + "json"))
        .when(text.contains(FENCE), body(text, FENCE))
        .otherwise(text),
    )


def _first_close(text: Column, opening: str, closing: str) -> Column:
    """``struct<depth, taken, done>`` after walking the pieces that end at each closing sign.

    Brackets inside strings count too. ``taken`` is the length up to the sign that brings the depth
    to zero when ``done``. The walk is one step per closing sign, not per character.
    """
    pieces = F.split(text, rf"(?<=\{closing})")
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("taken"), F.lit(False).alias("done"))

    def step(acc: Column, piece: Column) -> Column:
        depth = acc["depth"] + count_of(piece, opening) - count_of(piece, closing)
        return F.when(acc["done"], acc).otherwise(
            F.struct(
                depth.alias("depth"),
                (acc["taken"] + F.length(piece)).alias("taken"),
                (piece.endswith(closing) & (depth == 0)).alias("done"),
            )
        )

    return F.aggregate(pieces, start, step)


def balanced(text: Column, walk: Column) -> Column:
    """Cut a ``{``-text at its first balanced end, or append the signs that are missing.

    ``walk`` is ``_first_close`` of the same text, held in a column of its own.
    """
    with_braces = F.concat(text, F.lit("\n"), F.repeat(F.lit("}"), walk["depth"]))
    open_lists = count_of(text, "[") - count_of(text, "]")
    closed = F.when(
        open_lists > 0, F.concat(F.rtrim(with_braces, F.lit("}")), F.repeat(F.lit("]"), open_lists), F.lit("}"))
    ).otherwise(with_braces)
    return (
        F.when(~text.startswith("{"), text)
        .when(walk["done"], F.substring(text, F.lit(1), walk["taken"]))
        .otherwise(closed)
    )


def brace_walk(text: Column) -> Column:
    return F.when(text.startswith("{"), _first_close(text, "{", "}"))


def salvage_tail(raw: Column, field: str, window: int | None = None) -> Column:
    """Reply text from the ``[`` that follows the field name on, or null; ``window`` limits its length."""
    mark = f'"{field}"'

    def from_bracket(after: Column) -> Column:
        length = F.length(after) if window is None else F.lit(window)
        return F.when(after.contains("["), F.substring(after, F.instr(after, "["), length))

    return F.when(raw.contains(mark), let(F.substring(raw, F.instr(raw, mark), F.length(raw)), from_bracket))


def salvage_list(tail: Column) -> Column:
    """The string array at the start of a salvage tail, or null when it does not close or parse."""
    text = let(_first_close(tail, "[", "]"), lambda w: F.when(w["done"], F.substring(tail, F.lit(1), w["taken"])))
    return F.try_variant_get(F.try_parse_json(text), "$", "array<string>")


def size_issues(issues: Column, words: tuple[str, ...] = SIZE_WORDS) -> Column:
    return F.filter(issues, lambda t: contains_any(F.lower(t), words))


def error_class(error: Column) -> Column:
    low = F.lower(error)
    return (
        F.when(error.isNull(), F.lit(None).cast("string"))
        .when(error.contains("429") | low.contains("quota"), F.lit("quota"))
        .when(error.contains("403") & low.contains("moderation"), F.lit("moderation"))
        .when(error.contains("401") | low.contains("invalid"), F.lit("bad_key"))
        .otherwise(F.lit("other"))
    )


def without_fences(raw: Column) -> Column:
    """Reply without fence marks; text behind an unclosed last fence is dropped."""
    return let(
        F.split(strip(raw), FENCE),
        lambda parts: strip(
            F.array_join(F.when(F.size(parts) % 2 == 1, parts).otherwise(F.slice(parts, 1, F.size(parts) - 1)), "")
        ),
    )


def _is_from(line: Column) -> Column:
    return F.upper(F.substring(line, 1, 4)).eqNullSafe("FROM")


def buildfile_lines(lines: Column) -> Column:
    """The build-file part of reply lines: from the first FROM line on, else the lines that hold a
    build keyword, else everything. Needs ``lines`` as a column of its own."""
    first = F.array_position(F.transform(lines, lambda l: _is_from(strip(l))), True).cast("int")
    keyword = F.filter(lines, lambda l: contains_any(F.upper(l), FALLBACK_WORDS))
    return strip(
        F.array_join(
            F.when(first > 0, F.slice(lines, first, F.size(lines)))
            .when(F.size(keyword) > 0, keyword)
            .otherwise(lines),
            "\n",
        )
    )
