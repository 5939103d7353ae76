"""Benchmark decontamination by greedy string tiling.

Texts are compared as words: runs of letters and digits, ASCII letters in lower case. With ``scripts``, as the query and the
pipeline have it, letters and digits are those of Unicode, each character of a script without blanks is a word, and an
item shorter than a seed is one seed as a whole; without it bytes from 128 up count as letters. A document and a
benchmark item that share a seed (``SEED`` words in a row) often enough for the threshold are tiled: the
longest match of words not yet used is marked, again and again, down to the length of a seed. Matches are found by running
Karp-Rabin hashes and confirmed word by word. An item leaks into a document if its tiles cover
``COVER`` of its words, in whatever order they come. ``keep_clean`` drops documents only for items of ``SEED`` words or more: a shorter
item is an everyday phrase that clean documents hold too.

A bitmap of fixed size tells which windows of the documents may be seeds, so only those are
joined with the seeds of the benchmark.

Defined results: a null or empty text has no words and matches nothing. An item with fewer words than a seed
matches where all its words follow each other (nothing without ``scripts``). Rows with a null document or item id take no part and stay. Rows that repeat an id and differ
are compared each, the best cover counts. Ties go to the place that comes first in the item, then in the
document. Extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from . import linkage

SEED = 5
#: Least part of an item's words under tiles.
COVER = 0.5
BITMAP_BITS = 1 << 23  # fixed: one megabyte, whatever the benchmark

_BREAK = np.ones(256, bool)
_BREAK[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = False
_BREAK[128:] = False
#: First and last code points of scripts that set no blanks between words.
_NO_BLANKS = (
    (0x0E00, 0x109F),  # Thai, Lao, Tibetan, Myanmar
    (0x1780, 0x17FF),  # Khmer
    (0x1950, 0x1AAF),  # Tai Le, New Tai Lue, Buginese, Tai Tham
    (0x1B00, 0x1B7F),  # Balinese
    (0x2E80, 0x312F),  # Han radicals and marks, Hiragana, Katakana, Bopomofo
    (0x31A0, 0x31FF),
    (0x3400, 0x4DBF),  # Han
    (0x4E00, 0xA4CF),  # Han, Yi
    (0xA980, 0xA9FF),  # Javanese, Myanmar
    (0xAA00, 0xAADF),  # Cham, Myanmar, Tai Viet
    (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F),  # half-width Katakana
    (0x1AFF0, 0x1B16F),
    (0x20000, 0x3FFFF),
)


@lru_cache(1)
def _kinds() -> np.ndarray:
    """By code point: 0 between words, 1 part of a word, 2 a word of its own."""
    out = np.fromiter((unicodedata.category(chr(k))[0] in "LMN" for k in range(0x110000)), np.uint8, 0x110000)
    for low, high in _NO_BLANKS:
        out[low : high + 1] *= 2
    return out


def script_spans(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, stops, first)`` of the words by Unicode letters and digits, as ``common.spans`` gives them."""
    n = len(buf)
    kind = np.zeros(n + 5, np.uint8)  # one before the first byte, room for a cut character at the end
    kind[1 : n + 1] = ~_BREAK[buf]
    lead = np.flatnonzero(buf >= 0xC0)
    raw = np.concatenate([buf, np.zeros(3, np.uint8)])
    width = 2 + (buf[lead] >= 0xE0) + (buf[lead] >= 0xF0)
    point = buf[lead].astype(np.int64) & np.array([0, 0, 0x1F, 0x0F, 0x07])[width]
    for k in range(1, 4):
        point = np.where(width > k, point << 6 | raw[lead + k] & 0x3F, point)
    found = _kinds()[np.minimum(point, 0x10FFFF)]
    for k in range(4):
        some = width > k
        kind[1 + lead[some] + k] = found[some]
    kind[n + 1 :] = 0
    apart = np.zeros(n + 1, bool)  # places at which a word ends even if the next byte is in one
    apart[ends[1:-1]] = True
    first_byte = (buf & 0xC0) != 0x80
    apart[:-1] |= first_byte & ((kind[1 : n + 1] == 2) | (kind[:n] == 2))
    inside = kind > 0
    starts = np.flatnonzero(inside[1 : n + 2] & (~inside[: n + 1] | apart))
    stops = np.flatnonzero(inside[: n + 1] & (~inside[1 : n + 2] | apart))
    return starts, stops, np.searchsorted(starts, ends)


def word_hashes(col: pa.Array, scripts: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the number of words before each row."""
    buf, ends = c.text_bytes(col)
    buf = c.lower_ascii(buf)
    starts, stops, first = script_spans(buf, ends) if scripts and (buf >= 128).any() else c.spans(buf, ends, _BREAK)
    return c.span_hashes(buf, starts, stops), first


def seeds(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all full windows of ``n`` words and the row of each."""
    v, before = c.windows(words, first, n)
    row = np.repeat(np.arange(len(before) - 1), np.diff(before))
    full = np.diff(first)[row] >= n
    return v[full], row[full]


class _Runs:
    """Hashes of the runs of a word sequence, of any length, from prefix sums; which words are free."""

    def __init__(self, words: np.ndarray):
        up, self.down = c.powers(len(words))
        self.words, self.free = words, np.ones(len(words), bool)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)])])

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the free runs of ``n`` words."""
        taken = np.concatenate([[0], np.cumsum(~self.free)])
        at = np.flatnonzero(taken[n:] == taken[:-n])
        return at, (self.sums[at + n] - self.sums[at]) * self.down[at]


def tiles(item: np.ndarray, text: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Greedy string tiles ``(item position, text position, length)`` of two word sequences.

    Each step marks the longest match of unmarked words that has ``n`` words at least. Its length is found by halving, with running
    Karp-Rabin hashes of both sequences: if runs of some length match, shorter ones do. Memory follows the words, however
    often they repeat; equal hashes are confirmed on the words.
    """
    if not 0 < n <= min(len(item), len(text)):
        return []
    hi, _ = c.windows(item, np.array([0, len(item)]), n)
    ht, _ = c.windows(text, np.array([0, len(text)]), n)
    # Only words in runs that the item has too take part; a gap between them is one word that nothing equals.
    change = np.zeros(len(text) + 1, np.int64)
    met = np.flatnonzero(np.isin(ht, hi))
    np.add.at(change, met, 1)
    np.add.at(change, met + n, -1)
    near = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    gap = np.flatnonzero(np.diff(near) > 1) + 1
    place = np.insert(near, gap, -1)
    a, b = _Runs(item), _Runs(text[place])
    b.free = place >= 0
    out = []
    longest = min(len(item), len(place))
    while True:
        low, high = n - 1, longest  # runs of ``low`` words match, if it is not below ``n``; none beyond ``high`` does
        while low < high:
            k = (low + high + 1) // 2
            if np.isin(a.of(k)[1], b.of(k)[1]).any():
                low = k
            else:
                high = k - 1
        if low < n:
            return sorted(out)
        (at_a, hash_a), (at_b, hash_b) = a.of(low), b.of(low)
        order = np.argsort(hash_b, kind="stable")
        at_b, hash_b = at_b[order], hash_b[order]
        first, end = np.searchsorted(hash_b, hash_a, "left"), np.searchsorted(hash_b, hash_a, "right")
        turn: dict[int, int] = {}  # places before it are marked
        for p, f, e in zip(at_a.tolist(), first.tolist(), end.tolist(), strict=True):
            if f == e or not a.free[p : p + low].all():
                continue
            k = turn.get(f, f)
            while k < e:
                t = int(at_b[k])
                if b.free[t : t + low].all() and (a.words[p : p + low] == b.words[t : t + low]).all():
                    out.append((p, int(place[t]), low))
                    a.free[p : p + low] = b.free[t : t + low] = False
                    break
                k += 1
            turn[f] = k
        longest = low - 1  # every match of this length is marked or broken


def _seeds_of(sizes: list[int], scripts: bool, bitmap=None):
    """``id, seed, places`` of each row: its distinct seeds of these sizes (only those the bitmap may hold)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in c.slices(batches, "t"):
            words, first = word_hashes(part.column("t"), scripts)
            found = [seeds(words, first, n) for n in sizes]
            v, row = (np.concatenate(x) for x in zip(*found, strict=True))
            if bitmap is not None:
                bit = v % c._U(BITMAP_BITS)
                hit = (bitmap.value[(bit >> c._U(3)).astype(np.int64)] >> (bit & c._U(7)).astype(np.uint8)) & 1 == 1
                v, row = v[hit], row[hit]
            order = np.lexsort((v, row))
            v, row = v[order], row[order]
            new = np.ones(len(v), bool)
            new[1:] = (v[1:] != v[:-1]) | (row[1:] != row[:-1])
            at = np.flatnonzero(new)
            places = np.diff(np.append(at, len(v)))
            ids = part.column("id").take(pa.array(row[at]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(v[at].view(np.int64)), pa.array(places, pa.int64())], ["id", "seed", "places"])

    return run


def _counted(scripts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in c.slices(batches, "t"):
            _, first = word_hashes(part.column("t"), scripts)
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("t"), pa.array(np.diff(first), pa.int64())], ["id", "t", "n"])

    return run


def _bitmap(spark: SparkSession, items: DataFrame):
    """The seeds of the benchmark as a broadcast bitmap of fixed size."""
    bit = F.expr(f"cast(pmod(seed, {BITMAP_BITS}) as long)")
    words = items.select(bit.alias("b")).groupBy((F.col("b") / 64).cast("long").alias("w"))
    rows = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("m")).collect()
    out = np.zeros(BITMAP_BITS // 64, np.int64)
    for r in rows:
        out[r["w"]] = r["m"]
    return spark.sparkContext.broadcast(out.view(np.uint8))


def _tiled(n: int, scripts: bool):
    """The tiles of every text with each of its items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                items = batch.column("items")[k].values
                words, _ = word_hashes(batch.column("t").slice(k, 1), scripts)
                asked, first = word_hashes(items.field("item"), scripts)
                found = [tiles(asked[x:y], words, min(n, y - x) if scripts else n) for x, y in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                sizes = [[sum(x[2] for x in f) for f in found], [len(f) for f in found], [max((x[2] for x in f), default=0) for f in found]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").take(pa.array([k] * len(items))), items.field("item_id"), items.field("n"), *[pa.array(x, pa.int64()) for x in sizes]],
                    ["doc", "item_id", "n", "covered", "n_tiles", "longest"],
                )

    return run


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    seed: int = SEED,
    cover: float = COVER,
    scripts: bool = False,
) -> DataFrame:
    """``id_col, item_id, n_words, covered, n_tiles, longest, coverage`` of every pair at or above ``cover``."""
    spark = docs.sparkSession
    kind, item_kind = (df.schema[x].dataType.simpleString() for df, x in ((docs, id_col), (benchmark, item_col)))
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("t")).filter("id is not null and t is not null")
    items = benchmark.select(benchmark[item_col].alias("id"), benchmark[item_text_col].cast("string").alias("t"))
    items = c.stored(items.filter("id is not null and t is not null").distinct().mapInArrow(_counted(scripts), f"id {item_kind}, t string, n long"), "items")
    # Shorter items are one seed each; the documents are cut by the sizes there are.
    short = [r["n"] for r in items.filter(F.col("n").between(1, seed - 1)).select("n").distinct().collect()] if scripts else []
    found = [items.filter(F.col("n") >= seed).select("id", "t").mapInArrow(_seeds_of([seed], scripts), f"id {item_kind}, seed long, places long")]
    for n in sorted(short):
        found.append(items.filter(F.col("n") == n).select("id", "t").mapInArrow(_seeds_of([n], scripts), found[0].schema))
    wanted = c.stored(reduce(DataFrame.unionByName, found), "item-seeds")
    hits = texts.mapInArrow(_seeds_of([seed, *short], scripts, _bitmap(spark, wanted)), f"id {kind}, seed long, places long")
    hits = c.stored(hits.select(F.col("id").alias("doc"), "seed").distinct(), "hits")
    shared = hits.join(wanted.groupBy("seed", "id").agg(F.max("places").alias("places")), "seed")
    shared = shared.groupBy("doc", F.col("id").alias("item_id")).agg(F.sum("places").alias("places"))
    # Each place starts one window, so tiles cover at most a seed of words for each shared place.
    full = items.select(F.col("id").alias("item_id"), F.col("t").alias("item"), "n")
    pairs = shared.join(full, "item_id").filter(F.col("places") * seed >= F.lit(cover) * F.col("n"))
    pairs = c.stored(pairs.groupBy("doc").agg(F.collect_list(F.struct("item_id", "item", "n")).alias("items")), "pairs")  # a text meets its items at once
    c.discard(hits, wanted)
    some = linkage.maybe_in(texts, "id", pairs.select(F.col("doc").alias("id")))
    both = pairs.join(some.withColumnRenamed("id", "doc"), "doc")
    tiled = both.mapInArrow(_tiled(seed, scripts), f"doc {kind}, item_id {item_kind}, n long, covered long, n_tiles long, longest long")
    best = tiled.groupBy("doc", "item_id").agg(F.max(F.struct(F.col("covered") / F.col("n"), "n", "covered", "n_tiles", "longest")).alias("b"))
    return best.select(
        F.col("doc").alias(id_col),
        "item_id",
        F.col("b.n").alias("n_words"),
        F.col("b.covered").alias("covered"),
        F.col("b.n_tiles").alias("n_tiles"),
        F.col("b.longest").alias("longest"),
        (F.col("b.covered") / F.col("b.n")).alias("coverage"),
    ).filter(F.col("coverage") >= cover)


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", scripts: bool = False, least_words: int = SEED
) -> DataFrame:
    """``docs`` without the documents into which an item of ``least_words`` leaks.

    A shorter item is an everyday phrase that many clean documents hold; ``leaks`` lists these pairs all the same.
    """
    name = c.fresh_name(docs, "leaked_id")
    gone = leaks(docs, benchmark, id_col, text_col, scripts=scripts).filter(F.col("n_words") >= least_words)
    return docs.join(gone.select(F.col(id_col).alias(name)).distinct(), docs[id_col] == F.col(name), "left_anti")


def op3_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(c.table(spark, sf_dir, "documents"), c.table(spark, sf_dir, "benchmark"), scripts=True)
