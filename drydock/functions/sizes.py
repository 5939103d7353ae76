"""Byte counts to text and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# Units in steps of 1024.
UNITS = ("B", "KB", "MB", "GB", "TB", "PB")
_STEP = 1024


def _power(size: Column, highest: int) -> Column:
    """Which power of 1024 a size is counted in, at most ``highest``."""
    power = F.when(size < _STEP, 0)
    for i in range(1, highest):
        power = power.when(size < _STEP ** (i + 1), i)
    return power.otherwise(highest)


def _lookup(values: list[object], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def _scaled(size: Column, highest: int) -> Column:
    """``struct<value, power>``. The division by a power of two is exact, so the digits are too."""
    power = _power(size, highest)
    return F.struct((size / _lookup([_STEP**i for i in range(len(UNITS))], power)).alias("value"), power.alias("power"))


def compact_size(num_bytes: Column) -> Column:
    """``512B``, ``1.50MB``: two digits (ties to even), no space, whole bytes, up to TB."""
    size = num_bytes.cast("long")
    return let(
        _scaled(size, 4),
        lambda a: F.when(a["power"] == 0, F.concat(size.cast("string"), F.lit("B"))).otherwise(
            F.concat(F.format_string("%.2f", F.bround(a["value"], 2)), _lookup(list(UNITS), a["power"]))
        ),
    )


def spaced_size(num_bytes: Column) -> Column:
    """``512.0 B``, ``1.5 MB``: one digit (ties to even), with a space, up to PB."""
    return let(
        _scaled(num_bytes.cast("long"), 5),
        lambda a: F.concat(F.format_string("%.1f ", F.bround(a["value"], 1)), _lookup(list(UNITS), a["power"])),
    )


def signed_size(num_bytes: Column) -> Column:
    """``512 B``, ``1.50 MB``, ``-15.0 GB``, ``150 MB``: three significant digits (ties up), sign in
    front, up to PB."""

    def text(a: Column) -> Column:
        number = (
            F.when((a["value"] >= 100) | (a["power"] == 0), F.format_string("%.0f ", a["value"]))
            .when(a["value"] >= 10, F.format_string("%.1f ", a["value"]))
            .otherwise(F.format_string("%.2f ", a["value"]))
        )
        return F.concat(F.when(num_bytes < 0, F.lit("-")).otherwise(""), number, _lookup(list(UNITS), a["power"]))

    return F.when(num_bytes.isNull(), F.lit("0 B")).otherwise(let(_scaled(F.abs(num_bytes.cast("long")), 5), text))


def parse_size(text: Column, strict: bool = False) -> Column:
    """``struct<value double, unit string, bytes double>``; null parts when the text is no size.

    ``strict`` accepts only a number and a unit with white space between them.
    """
    gap = r"\s+" if strict else r"\s*"
    pattern = rf"^\s*([0-9]+(?:\.[0-9]+)?){gap}([A-Za-z]+)\s*$"
    factors = F.create_map(*[F.lit(x) for i, name in enumerate(UNITS) for x in (name, float(_STEP**i))])
    parts = F.struct(
        F.regexp_extract(text, pattern, 1).try_cast("double").alias("value"),
        F.nullif(F.upper(F.regexp_extract(text, pattern, 2)), F.lit("")).alias("unit"),
    )
    return let(
        parts,
        lambda p: F.struct(
            p["value"].alias("value"),
            p["unit"].alias("unit"),
            (p["value"] * F.try_element_at(factors, p["unit"])).alias("bytes"),
        ),
    )


def is_large_layer(text: Column, strict: bool = False) -> Column:
    """A size text counted in gigabytes, or above 200 MB; text that is no size is not large.

    A filter over every layer, so it works without regular expressions.
    """
    trimmed = F.trim(text)
    number, unit = F.substring(trimmed, F.lit(1), F.length(trimmed) - 2), F.upper(F.right(trimmed, F.lit(2)))
    value = number.try_cast("double")
    large = ((unit == "GB") & value.isNotNull()) | ((unit == "MB") & (value > 200))
    return F.coalesce(large & number.endswith(" ") if strict else large, F.lit(False))
