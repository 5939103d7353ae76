"""Line and whitespace handling shared by the file-text functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line breaks and the white space of Unicode text as the corpus tools count them.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same white space less the line breaks, as the body of a regex character class.
INLINE_SPACE = r"\t\x1f \x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it.

    Nested expressions are copied per use, which makes long ladders slow to run and to compile; a
    one-element array binds the value to a name instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITESPACE))


def split_lines(text: Column) -> Column:
    """Lines of a text, split at every Unicode line break."""
    return F.split(text, LINE_BREAK)


def text_lines(text: Column) -> Column:
    """As ``split_lines``, but a line break at the end of a text does not open another line."""
    return let(split_lines(text), lambda l: F.when(F.element_at(l, -1) == "", F.slice(l, F.lit(1), F.size(l) - 1)).otherwise(l))


def drop_last_char(text: Column) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - 1)


def count_of(text: Column, literal: str) -> Column:
    """Occurrences of a one-character literal."""
    return F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))


def contains_any(text: Column, words: list[str] | tuple[str, ...]) -> Column:
    """True when the text holds any of a fixed, short list of literals."""
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit


def last_segment(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def fallback(text: Column, default: str) -> Column:
    """Null and the empty string both give the default."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))
