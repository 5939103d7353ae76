"""Build-file text to instructions, inside one row.

A build file is one value, so its instructions are computed in the row that holds it: no shuffle,
no window, no group that could grow hot. Lines are folded into logical lines by gluing: a
continued line contributes its text and a space, a finished line its text and a newline, and one
split gives the logical lines back. The line-break set contains control characters that can
therefore not occur inside a line; two of them serve as brackets around directive lines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import INLINE_SPACE, drop_last_char, rstrip, split_lines, strip

_OPEN, _CLOSE = "\x1d", "\x1e"
_DIRECTIVE = f"{_OPEN}([^{_CLOSE}]*){_CLOSE}"
# Text before the first '#' outside quotes; either quote sign opens or closes a quoted part.
_BEFORE_COMMENT = r"""^(?:[^"'#]++|["'][^"']*+(?:["']|$))*+"""
_FIRST_WORD = f"^[{INLINE_SPACE}]*([^{INLINE_SPACE}]+)"
_FIRST_WORD_AND_GAP = f"^[{INLINE_SPACE}]*[^{INLINE_SPACE}]+[{INLINE_SPACE}]*"


def cut_comment(line: Column) -> Column:
    """Drop an unquoted trailing comment; lines without '#' skip the regex."""
    return F.when(
        line.contains("#"), rstrip(F.regexp_extract(line, _BEFORE_COMMENT, 0))
    ).otherwise(line)


def _is_directive(line: Column) -> Column:
    return F.lower(F.substring(line, 1, 9)) == "# syntax="


# The steps to logical lines. Each result is used several times by the next step, so each belongs in
# a column of its own (see ``operators.lint.logical_lines``); nested, it would be computed per use.


def kept_lines(content: Column) -> Column:
    """Stripped lines without blanks and comments; directive lines stay."""
    lines = F.transform(split_lines(content), strip)
    return F.filter(lines, lambda t: (t != "") & (~t.startswith("#") | _is_directive(t)))


def glued_lines(kept: Column) -> Column:
    """Logical lines with bracketed directives inside; the last element is the unfinished rest."""
    bodies = F.transform(
        kept,
        lambda t: F.when(t.startswith("#"), F.concat(F.lit(_OPEN), t, F.lit(_CLOSE))).otherwise(cut_comment(t)),
    )
    pieces = F.transform(
        bodies,
        lambda b: F.when((b == "") | b.startswith(_OPEN), b)
        .when(b.endswith("\\"), F.concat(rstrip(drop_last_char(b)), F.lit(" ")))
        .otherwise(F.concat(b, F.lit("\n"))),
    )
    return F.split(F.array_join(pieces, ""), "\n")


def has_directive(kept: Column) -> Column:
    return F.exists(kept, lambda t: t.startswith("#"))


def finished_lines(glued: Column, directives: Column) -> Column:
    """Finished logical lines; directive lines come before the line they were found in.

    A continuation that never ends before the end of the file yields nothing.
    """
    with_directives = F.flatten(
        F.transform(
            glued,
            lambda l, i: F.concat(
                F.regexp_extract_all(l, F.lit(_DIRECTIVE), F.lit(1)),
                F.when(i < F.size(glued) - 1, F.array(F.regexp_replace(l, _DIRECTIVE, ""))).otherwise(
                    F.array().cast("array<string>")
                ),
            ),
        )
    )
    return F.when(directives, with_directives).otherwise(F.slice(glued, 1, F.size(glued) - 1))


def as_instruction(line: Column) -> Column:
    """A logical line as ``struct<instruction, value>``; the keyword is upper-cased."""
    directive = line.startswith("#")
    return F.struct(
        F.when(directive, F.lit("SYNTAX"))
        .otherwise(F.upper(F.regexp_extract(line, _FIRST_WORD, 1)))
        .alias("instruction"),
        F.when(directive, line).otherwise(F.regexp_replace(line, _FIRST_WORD_AND_GAP, "")).alias("value"),
    )


def instructions(lines: Column) -> Column:
    return F.transform(lines, as_instruction)


def is_buildfile_name(file_name: Column) -> Column:
    name = F.lower(file_name)
    return (name == "dockerfile") | name.startswith("dockerfile.")


def is_plausible(content: Column) -> Column:
    """Not blank, and some non-comment line starts with FROM in any case."""
    return F.exists(
        F.transform(F.split(content, "\n"), strip),
        lambda t: ~t.startswith("#") & F.upper(F.substring(t, 1, 4)).eqNullSafe("FROM"),
    )
