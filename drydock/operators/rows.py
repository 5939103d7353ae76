"""Array columns to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unfold(df: DataFrame, keys: Sequence[str], array: Column, name: str, pos: str | None = None) -> DataFrame:
    """One row per non-null array element.

    The outer form plus a test of the element keeps the optimiser from adding a size filter on the
    array below the explode, which would compute a costly array a second time.
    """
    if pos is None:
        rows = df.select(*keys, F.explode_outer(array).alias(name))
    else:
        rows = df.select(*keys, F.posexplode_outer(array).alias(pos, name))
    return rows.filter(F.col(name).isNotNull())


def hold(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """Rows whose ``value`` is not null, with the value computed once.

    A plain filter on a computed column is pushed below it and computes it again.
    """
    return unfold(df, keys, F.array(value), name)


#: Bits of a membership bitmap for each key, and its most 64-bit words: the bound of what is broadcast.
BITS_PER_KEY, BITMAP_WORDS = 16, 1 << 20


def maybe_in(df: DataFrame, keys: Sequence[str], others: DataFrame) -> DataFrame:
    """The rows of ``df`` whose keys may be in ``others``: all that are, and one in 16 of the others, more beyond some 4 million keys.

    A bitmap sized by the number of keys is broadcast; nothing else moves.
    """
    words = min(BITMAP_WORDS, others.count() * BITS_PER_KEY // 64 + 1)
    bit = F.pmod(F.xxhash64(*keys), F.lit(words * 64))
    masks = others.select(bit.alias("_bit")).select(
        F.expr("_bit div 64").alias("_word"), F.expr("shiftleft(1L, cast(_bit % 64 as int))").alias("_mask")
    )
    masks = masks.groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    marked = df.withColumn("_bit", bit)
    hit = marked.join(F.broadcast(masks), F.expr("_bit div 64") == F.col("_word"))
    return hit.filter(F.expr("(shiftright(_mask, cast(_bit % 64 as int)) & 1) = 1")).drop("_bit", "_word", "_mask")
