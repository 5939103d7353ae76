"""Size rewrites of build-file text, inside one row.

The three rewrites touch different parts of a line, and each is the identity on its own output, so
one application per rewrite gives the text that repeated application per finding would give.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import rstrip

# Command texts, flags and the clean-up command.
APT_INSTALL, APT_FLAG = "apt-get install", "--no-install-recommends"
PIP_INSTALL, PIP_FLAG = "pip install", "--no-cache-dir"
LIST_CLEANUP = "rm -rf /var/lib/apt/lists"
CLEANUP_TAIL = " && rm -rf /var/lib/apt/lists/*"
# A line end after a backslash and blanks, and each one that follows it after blanks only, continues the command.
CONTINUATION = r"(\\|(?!^)\G)([ \t\r]*)\n"
_HELD = "\x01"  # stands for a line end inside a command
ENDS_IN_COMMENT = r"\n[ \t]*#[^\n]*$"
CLEANUP_LINE = "\n    && rm -rf /var/lib/apt/lists/* \\"


def _lacks_flag(line: Column, command: str, flag: str) -> Column:
    return line.contains(command) & ~line.contains(flag)


def add_flag(lines: Column, command: str, flag: str) -> Column:
    """Put the flag after every occurrence of the command on lines without the flag."""
    return F.transform(
        lines,
        lambda l: F.when(
            _lacks_flag(l, command, flag), F.replace(l, F.lit(command), F.lit(f"{command} {flag}"))
        ).otherwise(l),
    )


def count_flag_edits(lines: Column, command: str, flag: str) -> Column:
    return F.size(F.filter(lines, lambda l: _lacks_flag(l, command, flag)))


def _needs_cleanup(lines: Column, line: Column, i: Column) -> Column:
    """An installing command chain with no clean-up within two lines either way."""
    start = F.greatest(i - 1, F.lit(1))
    around = F.slice(lines, start, i + 3 - start + 1)
    return (
        line.contains(APT_INSTALL)
        & line.contains("&&")
        & ~F.exists(around, lambda n: n.contains(LIST_CLEANUP))
    )


def add_cleanup(lines: Column) -> Column:
    return F.transform(
        lines,
        lambda l, i: F.when(
            _needs_cleanup(lines, l, i),
            F.when(rstrip(l).endswith("\\"), F.concat(rstrip(l), F.lit(CLEANUP_LINE)))
            .when(rstrip(l).endswith("&&"), l)
            .otherwise(F.concat(rstrip(l), F.lit(CLEANUP_TAIL))),
        ).otherwise(l),
    )


def _command_needs_cleanup(command: Column) -> Column:
    return (
        command.contains(APT_INSTALL)
        & command.contains("&&")
        & ~command.contains(LIST_CLEANUP)
        & ~rstrip(command).endswith("&&")
        & ~rstrip(command).endswith("\\")
        & ~command.rlike(ENDS_IN_COMMENT)
    )


def commands(content: Column) -> Column:
    """The commands of a text, their lines joined as ``_HELD`` text; one pass, whatever the length of a continuation."""
    plain = F.replace(F.replace(content, F.lit("\x02"), F.lit("\x02b")), F.lit(_HELD), F.lit("\x02a"))
    return F.split(F.regexp_replace(plain, CONTINUATION, f"$1$2{_HELD}"), "\n")


def _text(command: Column) -> Column:
    lines = F.replace(command, F.lit(_HELD), F.lit("\n"))
    return F.replace(F.replace(lines, F.lit("\x02a"), F.lit(_HELD)), F.lit("\x02b"), F.lit("\x02"))


def clean_commands(commands_: Column) -> Column:
    """``(text, edited)`` of each command: the same clean-up goes to the end of the last line of a continued
    command, never into the middle of a package list."""

    def cleaned(held: Column) -> Column:
        c = _text(held)
        return F.when(_command_needs_cleanup(c), F.struct(F.concat(rstrip(c), F.lit(CLEANUP_TAIL)).alias("text"), F.lit(True).alias("edited"))).otherwise(
            F.struct(c.alias("text"), F.lit(False).alias("edited"))
        )

    # Only commands that install are looked at closely.
    return F.transform(
        commands_,
        lambda c: F.when(c.contains(APT_INSTALL), cleaned(c)).otherwise(F.struct(_text(c).alias("text"), F.lit(False).alias("edited"))),
    )


def count_cleanup_hits(lines: Column) -> Column:
    """Lines that get a clean-up, plus those that would but end in '&&'."""
    hits = F.transform(lines, lambda l, i: _needs_cleanup(lines, l, i))
    return F.size(F.filter(hits, lambda h: h))


def count_dangling_hits(lines: Column) -> Column:
    """The hits that end in '&&': logged as a change, left unedited."""
    hits = F.transform(lines, lambda l, i: _needs_cleanup(lines, l, i) & rstrip(l).endswith("&&"))
    return F.size(F.filter(hits, lambda h: h))
