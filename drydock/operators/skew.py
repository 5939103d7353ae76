"""Keyed work that survives a key holding a large share of all rows.

Ordered work over a key is done in blocks: the rows of one (key, block) are ordered in one task,
per-block summaries are scanned over the few blocks of a key, and the two are joined on
(key, block). Blocks are cut at rows of the key that a hash of the whole order tuple picks, about one in
``block_rows``: so they hold about that many rows wherever the key's rows lie along the order, for any
orderable type, and the same ones when a task is run again. A key with few rows has no cut and one block.
Rows that agree in the whole order tuple stay together; give an order that tells rows apart.
Cuts, and the summaries of the blocks of keys that have cuts, are about a millionth of the rows, so they are broadcast: the
rows themselves move once, to the task of their block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_ROWS = 1_000_000
# Steps of the search for a block: enough for 2**20 cuts in a key.
SEARCH_BITS = 20


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. Spark keeps one row per key and map task before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def with_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``_block``, which does not decrease along ``order`` within ``keys``.

    The cuts of a key come as one sorted array, about one for ``block_rows`` rows; a row finds its block by
    binary search.
    """
    return _blocked(df, keys, order, block_rows).drop("_several")


def _blocked(df: DataFrame, keys: Sequence[str], order: Sequence[str], block_rows: int) -> DataFrame:
    """``with_blocks``, and whether the key has ``_several`` blocks."""
    at = F.struct(*order)
    picked = df.filter(F.pmod(F.xxhash64(*keys, *order), F.lit(block_rows)) == 0)
    cuts = F.broadcast(picked.groupBy(*keys).agg(F.array_sort(F.collect_set(at)).alias("_cuts")))
    joined = _add_by_key(df.withColumn("_at", at), cuts, keys, "left") if keys else df.withColumn("_at", at).join(cuts, how="left")

    def step(found: Column, bit: Column) -> Column:
        to = found + F.call_function("shiftleft", F.lit(1), bit)
        inside = to <= F.size("_cuts")
        return F.when(inside & (F.get("_cuts", F.when(inside, to - 1)) <= F.col("_at")), to).otherwise(found)

    several = F.coalesce(F.size("_cuts") > 0, F.lit(False))
    bits = F.sequence(F.lit(SEARCH_BITS), F.lit(0), F.lit(-1))
    block = F.when(several, F.aggregate(bits, F.lit(0), step)).otherwise(F.lit(0))
    return joined.withColumn("_block", block).withColumn("_several", several).drop("_cuts", "_at")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    total: str = "cumulative",
    number: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Running sum of ``value``, and the 1-based row number, in ``order`` within ``keys``."""
    keys = list(keys)
    blocked = _blocked(df, keys, order, block_rows)
    sums = blocked.filter("_several").groupBy(*keys, "_block").agg(F.sum(value).alias("_t"), F.count(F.lit(1)).alias("_c"))
    before = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_block", F.sum("_t").over(before).alias("_base"), F.sum("_c").over(before).alias("_skip"))
    inside = W.partitionBy(*keys, "_block").orderBy(*order)
    upto = inside.rowsBetween(W.unboundedPreceding, 0)
    joined = _add_by_key(blocked, F.broadcast(offsets), [*keys, "_block"], "left")
    out = joined.withColumn(total, F.coalesce("_base", F.lit(0)) + F.coalesce(F.sum(value).over(upto), F.lit(0)))
    if number:
        out = out.withColumn(number, F.coalesce("_skip", F.lit(0)) + F.row_number().over(inside))
    return out.drop("_block", "_several", "_base", "_skip")


def quantiles(df: DataFrame, value: str, shares: dict[str, float], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row with the exact quantiles of a column, interpolated between ranks, under the names of ``shares``; nulls do not count.

    Equal values are counted first; running counts over blocks of the different ones say which hold the ranks. So no task
    holds all values, and a value that most rows have is one row.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c"))
    upto = running(counts, [], ["_v"], "_c", total="_upto", block_rows=block_rows)
    total = counts.agg(F.sum("_c").alias("_n"))
    ranked = upto.crossJoin(total)  # one row
    at = {name: (F.col("_n") - 1) * F.lit(float(share)) for name, share in shares.items()}
    found = ranked.agg(
        F.max("_n").alias("_n"),
        *[F.min(F.when(F.col("_upto") > edge(p), F.col("_v"))).alias(f"_{kind}_{name}") for name, p in at.items() for kind, edge in (("low", F.floor), ("high", F.ceil))],
    )

    def between(name: str) -> Column:
        low, high, p = F.col(f"_low_{name}"), F.col(f"_high_{name}"), at[name]
        return F.when((low == high) | (F.floor(p) == F.ceil(p)), low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high)

    return found.select(*[between(name).alias(name) for name in shares])


def _add_by_key(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join that matches null keys, to a right side with one row per key."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def _carry(df: DataFrame, keys: list[str], order: Sequence[str], value: Column, skip_nulls: bool) -> DataFrame:
    """Per (keys, _block) of keys with several blocks: ``value`` of the last row in all earlier blocks, as ``_carry``.

    ``skip_nulls`` takes the last row that has a value.
    """
    position = F.struct(*order)
    if skip_nulls:
        position = F.when(value.isNotNull(), position)
    blocks = df.filter("_several").groupBy(*keys, "_block").agg(F.max_by(F.struct(value.alias("v")), position).alias("_last"))
    w = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    return F.broadcast(blocks.select(*keys, "_block", F.last("_last", ignorenulls=True).over(w)["v"].alias("_carry")))


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Replace null or blank ``column`` by the last value above it within ``keys``."""
    keys = list(keys)
    blank = df.withColumn(column, F.nullif(F.trim(column), F.lit("")))
    blocked = _blocked(blank, keys, order, block_rows)
    carry = _carry(blocked, keys, order, F.col(column), skip_nulls=True)
    inside = W.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    filled = _add_by_key(blocked, carry, [*keys, "_block"], "left").withColumn(
        column, F.coalesce(F.last(column, ignorenulls=True).over(inside), F.col("_carry"))
    )
    return filled.drop("_block", "_several", "_carry")


def previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, out: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Value of ``column`` in the row before, within ``keys``; null in the first row."""
    keys = list(keys)
    blocked = _blocked(df, keys, order, block_rows)
    carry = _carry(blocked, keys, order, F.col(column), skip_nulls=False)
    inside = W.partitionBy(*keys, "_block").orderBy(*order)
    joined = _add_by_key(blocked, carry, [*keys, "_block"], "left")
    first = F.row_number().over(inside) == 1
    return joined.withColumn(
        out, F.when(first, F.col("_carry")).otherwise(F.lag(column).over(inside))
    ).drop("_block", "_several", "_carry")
