"""Fuzzy line dedup by MinHash.

A line is the text between line breaks without blanks at its ends; lines without a word take no part. Its set
is its runs of ``SHINGLE`` characters. Equal lines are one item, told by two 64-bit hashes. MinHash bands give buckets of
items, candidates are confirmed on full sets (shingles told apart by 64-bit hashes), and links are joined by distributed union-find.
Of each component the first line stays, in the order of document id and line number. Texts are scanned for the places of
their lines, for the bands, and for the lines that share a bucket; neither lines nor bands are stored for all of them.

With 22 bands of 5 a pair at similarity 0.8 is missed about once in 6,000, at 0.9 less than once in a hundred million. One changed
character leaves 0.8 or more in lines from 49 characters, a replaced word of six letters in lines from 94; changes in shorter
lines are below the threshold and not linked.

Defined results: a null or blank text has no lines. A line shorter than a shingle is its own single shingle.
Lines of rows with a null id take no part, and such rows stay as they are. Rows that repeat an id count as
one document. A document of which no worded line stays is dropped by ``remove_repeats``; one that had none stays.
Extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import common as c
from . import linkage
from .minhash import band_keys

SHINGLE = 5
BANDS, ROWS = 22, 5
#: Bytes of text that one numpy step handles, and shingles that stay in the processor's cache while their signatures are made.
STEP, NEAR = 1 << 19, 1 << 16
#: Blanks that go one by one at each end of all lines, and bits of the place in a bitmap of the runs of a line.
TRIMS, RUN_BITS = 8, 10
SIMILAR = 80
BLANKS = " \\t\\n\\u000B\\f\\r"


def line_spans(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, stop, row and number in its row of every line with a word, blanks at its ends left out."""
    breaks = np.flatnonzero(buf == 10)
    first = np.searchsorted(breaks, ends) + np.arange(len(ends))  # the lines before each row
    row = np.repeat(np.arange(len(ends) - 1), np.diff(first))
    number = np.arange(first[-1]) - first[row]
    starts, stops = np.empty((2, first[-1]), np.int64)
    head, tail = np.zeros((2, first[-1]), bool)
    head[first[:-1]] = True
    tail[first[1:] - 1] = True
    starts[head], starts[~head] = ends[:-1], breaks + 1
    stops[tail], stops[~tail] = ends[1:], breaks
    full = np.flatnonzero(starts < stops)
    starts, stops, row, number = starts[full], stops[full], row[full], number[full]
    for turn, left in enumerate((True, False)):
        at = np.arange(len(starts))
        for _ in range(TRIMS):
            at = at[c._BLANK[buf[starts[at] if left else stops[at] - 1]]]
            (starts if left else stops)[at] += 1 - 2 * turn
            at = at[starts[at] < stops[at]]
        if len(at):  # long runs of blanks
            words = np.flatnonzero(~c._BLANK[buf])
            k = np.searchsorted(words, starts[at] if left else stops[at])
            if left:
                starts[at] = np.minimum(np.append(words, len(buf))[k], stops[at])
            else:
                stops[at] = np.maximum(np.append(-1, words)[k] + 1, starts[at])
    full = np.flatnonzero(starts < stops)
    return starts[full], stops[full], row[full], number[full]


def shingle_hashes(
    buf: np.ndarray, starts: np.ndarray, stops: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character runs of each span (spans in the order of the buffer), and the number of runs before each span.

    Runs are hashed at every character of the buffer at once, and those that leave their span are left out.
    """
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    limit = np.append(lead, len(buf))
    n = len(lead)
    a, b = np.searchsorted(lead, starts), np.searchsorted(lead, stops)
    short = b - a < size
    runs = np.where(short, 1, b - a - size + 1)
    _, down = c.powers(len(buf))
    total = c.prefix_sums(buf)
    out = np.zeros(n, np.uint64)
    m = max(n - size + 1, 0)
    ends = total if n == len(buf) else total.take(limit)
    np.subtract(ends[n + 1 - m :], ends[:m], out=out[:m])
    out[:m] *= down[:m] if n == len(buf) else down.take(lead[:m])
    out[:m] += c._U(size) if n == len(buf) else (limit[n + 1 - m :] - limit[:m]).view(np.uint64)
    few = np.flatnonzero(short)
    out[a[few]] = c.short_hashes(buf, starts[few], stops[few], total)
    change = np.zeros(n + 1, np.int8)
    change[a] += 1
    np.subtract.at(change, a + runs, 1)
    inside = np.cumsum(change[:-1], dtype=np.int8).view(bool)
    return c.mix(out[inside]), np.concatenate([[0], np.cumsum(runs)])


def signature(values: np.ndarray, before: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash coordinates per span; odd multiples and shifts of 32-bit words order the shingles."""
    x = (values >> c._U(32)).astype(np.uint32)
    orders = np.random.default_rng(20).integers(0, 1 << 32, (n, 2), np.uint32)
    orders[:, 0] |= np.uint32(1)
    out = np.empty((len(before) - 1, n), np.uint32)
    a = 0
    while a < len(out):
        b = max(a + 1, int(np.searchsorted(before, before[a] + NEAR, "right")) - 1)
        part, at = x[before[a] : before[b]], before[a:b] - before[a]
        work = np.empty_like(part)
        for k in range(n):
            np.multiply(part, orders[k, 0], out=work)
            np.add(work, orders[k, 1], out=work)
            out[a:b, k] = np.minimum.reduceat(work, at)
        a = b
    return out


def line_hashes(buf: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each span, of a byte at least: sums of its mixed words of eight bytes, each with its place, in two ways."""
    n = (stops - starts + 7) >> 3
    ends = np.cumsum(n)
    if not len(n):
        return np.zeros((2, 0), np.uint64)
    place = np.arange(ends[-1]) - np.repeat(ends - n, n)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    word = np.ndarray(len(buf) + 1, "<u8", padded, strides=(1,))[np.repeat(starts, n) + 8 * place]
    over = (8 * n - (stops - starts)).astype(np.uint64) << c._U(3)  # bits of the last word that lie behind the span
    word[ends - 1] &= ~c._U(0) >> over
    x = c.mix(word * c._PRIME + place.astype(np.uint64) * c._U(0xD6E8FEB86659FD93))
    y = (x ^ (x >> c._U(29))) * c._U(0xBF58476D1CE4E5B9)
    y ^= y >> c._U(32)
    size = (stops - starts).astype(np.uint64)
    return tuple(c.mix(np.add.reduceat(z, ends - n) + size * c._PRIME) for z in (x, y))


def _lines(part: pa.RecordBatch):
    """The buffer, and start, stop, row, number and both hashes of every line with a word."""
    buf, ends = c.text_bytes(part.column("t"))
    starts, stops, row, number = line_spans(buf, ends)
    return buf, starts, stops, row, number, *line_hashes(buf, starts, stops)


def _distinct(k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The item of each different line, and its first place, in the order of the places."""
    _, head = np.unique(k1 ^ k2, return_index=True)
    head.sort()
    return (k1 ^ k2)[head].view(np.int64), head


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in c.slices(batches, "t", STEP):
        _, _, _, row, number, k1, k2 = _lines(part)
        yield pa.RecordBatch.from_arrays(
            [part.column("id").take(pa.array(row)), pa.array(number, pa.int32()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64))],
            ["doc", "line", "k1", "k2"],
        )


def _banded(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in c.slices(batches, "t", STEP):
            buf, starts, stops, _, _, k1, k2 = _lines(part)
            if not len(starts):
                continue
            items, head = _distinct(k1, k2)
            v, before = shingle_hashes(buf, starts[head], stops[head], size)
            coordinates = signature(v, before, max(bands * rows, linkage.SKETCH))
            keys, sketches = band_keys(coordinates[:, : bands * rows], rows), linkage.sketch_bits(coordinates)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(items) + 1, dtype=np.int32) * bands), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(items), lists, pa.array(sketches.view(np.int64))], ["id", "bucket", "sketch"])

    return run


def _line_texts(known: Broadcast):
    """The different lines whose items may be known, see ``linkage.bitmap``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in c.slices(batches, "t", STEP):
            buf, starts, stops, _, _, k1, k2 = _lines(part)
            items, head = _distinct(k1, k2)
            on = linkage.in_bitmap(items, known.value)
            items, head = items[on], head[on]
            lines = [buf[a:b].tobytes() for a, b in zip(starts[head].tolist(), stops[head].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(items), pa.array(lines, pa.binary()).cast(pa.string())], ["id", "l"])

    return run


def char_set(line: str, size: int = SHINGLE) -> frozenset[str]:
    return frozenset(line[i : i + size] for i in range(max(1, len(line) - size + 1)))


def _distinct_sorted(values: np.ndarray) -> np.ndarray:
    x = np.sort(values.view(np.int64))
    new = x[1:] != x[:-1]
    return x if new.all() else x[np.concatenate([[True], new])]


def hashed_sets(size: int):
    """The shingle hashes of each line, sorted and distinct."""

    def sets(column: pa.Array) -> list[np.ndarray]:
        buf, ends = c.text_bytes(column)
        v, before = shingle_hashes(buf, ends[:-1], ends[1:], size)
        return [_distinct_sorted(v[a:b]) for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True)]

    return sets


def _run_maps(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of each line's runs, the number of runs before each line, and a bitmap of the hashes.

    Each bit that only one of two bitmaps has stands for an element that only one of the sets has.
    """
    buf, ends = c.text_bytes(column)
    v, before = shingle_hashes(buf, ends[:-1], ends[1:], size)
    runs = np.diff(before)
    bits = np.zeros(len(runs) << RUN_BITS, bool)
    bits[np.repeat(np.arange(len(runs)) << RUN_BITS, runs) + (v >> c._U(64 - RUN_BITS)).view(np.int64)] = True
    return v, before, np.packbits(bits).view(np.uint64).reshape(len(runs), -1)


def _similar(size: int, percent: int):
    """Keeps the pairs ``(a, b)`` whose lines ``ta, tb`` are similar enough. Sets are made for the pairs that their bitmaps leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in c.slices(batches, "tb", 1 << 20):
            left = part.column("ta").dictionary_encode()  # a leader meets many
            lead = left.indices.to_numpy()
            (va, fa, ma), (vb, fb, mb) = (_run_maps(x, size) for x in (left.dictionary, part.column("tb")))
            apart = np.bitwise_count(ma[lead] ^ mb).sum(axis=1, dtype=np.int64)
            close = np.flatnonzero(apart * (100 + percent) <= (np.diff(fa)[lead] + np.diff(fb)) * (100 - percent))
            sets, hits = {}, np.zeros(part.num_rows, bool)
            for k in close.tolist():
                of = lead[k]
                x = sets.get(of)
                if x is None:
                    x = sets[of] = _distinct_sorted(va[fa[of] : fa[of + 1]])
                y = _distinct_sorted(vb[fb[k] : fb[k + 1]])
                both = 0
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    z = np.concatenate([x, y])
                    z.sort()
                    both = int(np.count_nonzero(z[1:] == z[:-1]))
                hits[k] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(hits))

    return run


def line_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = SIMILAR,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``id_col, line_no`` (from 0) of every worded line, ``first_doc, first_line`` of its component, and ``kept``."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("t")).filter("id is not null")
    place = F.struct("doc", "line")
    lines = c.stored(texts.mapInArrow(_places, f"doc {kind}, line int, k1 long, k2 long"), "places")

    def prepare(ids: DataFrame):
        known = linkage.bitmap(ids, "id")
        found = texts.select("t").mapInArrow(_line_texts(known), "id long, l string")
        # The bitmap lets others through, the more the more ids there are; they go before the texts are stored.
        text = c.stored(found.groupBy("id").agg(F.min("l").alias("l")).join(ids, "id", "left_semi"), "candidates")
        n_texts, tables = text.count(), [text]

        def similar(pairs: DataFrame) -> DataFrame:
            pairs = c.stored(pairs, "pairs")
            tables.append(pairs)
            ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
            own = linkage.maybe_in(text, "id", ends) if 2 * ends.count() < n_texts else text  # later pairs are of few texts
            # The last join is on the leader, so its rows follow each other and its set is built once.
            both = pairs.join(own.select(F.col("id").alias("b"), F.col("l").alias("tb")), "b")
            both = both.join(own.select(F.col("id").alias("a"), F.col("l").alias("ta")), "a")
            both = both.select("a", "b", "ta", "tb")
            return both.mapInArrow(_similar(size, percent), "a long, b long").distinct()

        return linkage.Compare(similar, text.withColumnRenamed("l", "v"), hashed_sets(size), percent, tables)

    comps = linkage.linked(texts.select("t"), prepare, percent, _banded(size, bands, rows))
    reps = lines.groupBy("k1", "k2").agg(F.min(place).alias("rep"))
    # Few lines have a component, and only these are told apart by id; all others meet by both hashes, where they are.
    of = linkage.maybe_in(lines.withColumn("id", F.col("k1").bitwiseXOR(F.col("k2"))), "id", comps.select("id"))
    of = of.groupBy("id", "k1", "k2").agg(F.min(place).alias("rep")).join(comps, "id")
    of = c.stored(of.select("k1", "k2", "component", "rep"), "reps")
    met = of.groupBy("component").agg(F.min("rep").alias("first"))
    firsts = c.stored(of.join(met, "component").select("k1", "k2", "first"), "firsts")
    c.discard(comps, of)
    reps = reps.join(firsts, ["k1", "k2"], "left").select("k1", "k2", F.coalesce("first", "rep").alias("first"))
    joined = lines.join(reps, ["k1", "k2"])
    return joined.select(
        F.col("doc").alias(id_col),
        F.col("line").alias("line_no"),
        F.col("first.doc").alias("first_doc"),
        F.col("first.line").alias("first_line"),
        (F.col("first") == place).alias("kept"),
    )


@F.pandas_udf(StringType())
def _without(texts: pd.Series, gone: pd.Series) -> pd.Series:
    """The texts without the lines of these numbers; a null text stays null."""
    out = []
    for text, numbers in zip(texts, gone, strict=True):
        if text is not None:
            lines = text.split("\n")
            left = np.ones(len(lines), bool)
            left[numbers] = False
            text = "\n".join([lines[k] for k in np.flatnonzero(left)])
        out.append(text)
    return pd.Series(out, dtype=object)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines that repeat an earlier one, and without documents of which no line stays."""
    classes = line_classes(docs, id_col, text_col)
    id_, gone, rest = (c.fresh_name(docs, x) for x in ("id_of_lines", "gone_lines", "rest_of_text"))
    found = classes.filter("not kept").groupBy(F.col(id_col).alias(id_)).agg(F.collect_set("line_no").alias(gone))
    joined = docs.join(found, docs[id_col] == F.col(id_), "left")
    some = F.col(gone).isNotNull()
    joined = joined.withColumn(rest, _without(F.when(some, docs[text_col].cast("string")), F.col(gone)))
    text = F.when(some, F.col(rest)).otherwise(docs[text_col])
    out = joined.filter(~some | F.col(rest).rlike(f"[^{BLANKS}]"))
    return out.select(*[text.alias(x) if x == text_col else docs[x] for x in docs.columns])


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(c.table(spark, sf_dir, "documents"))
