"""Packing of token sequences by the linear grouping scheme.

A document longer than a sequence is cut into full pieces after a first, shorter one. The packing is
planned on the histogram of piece lengths, which has at most one number per length, and then applied to
the pieces by their rank among those of the same length:

1. Large lengths are sorted into groups of equal cardinality and rounded up to the largest of their group.
2. The few sizes left are packed by configurations: a linear program, solved by column generation, its
   solution rounded down.
3. Actual pieces take the places of the rounded ones, which leaves room beside them.
4. The pieces left over and the small ones go, largest first, to the sequence with the least room that fits.

Bins that look alike are planned together as one run, so the plan is small whatever the number of
documents. The driver sees the histogram and the plan only.

Defined results: a null or empty text is one piece, the end id. Rows that repeat an id are packed each; a null id
is kept. Ties between pieces of one length go by id, piece and checksum. Extra columns do not matter; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .tokens import END_ID, REMEMBERED, TOKENIZER, Coder

CAPACITY = 1024
#: Lengths above this share of a sequence are large.
LARGE = 1 / 8
GROUPS = 128
#: Pieces of one length that one task ranks.
RANK_ROWS = 100_000
PIECE = "piece int, start long, length long, ids_crc32 long"


# --- the plan ------------------------------------------------------------------------------------


def _fill(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The worthiest multiset of sizes within the capacity: its worth and its counts."""
    best = np.zeros(capacity + 1)
    for size, gain in zip(sizes.tolist(), worth.tolist(), strict=True):
        for _ in range(capacity // size if gain > 0 else 0):
            np.maximum(best[size:], best[:-size] + gain, out=best[size:])
    counts, room = np.zeros(len(sizes)), capacity
    while best[room] > 1e-9:
        fits = np.flatnonzero(sizes <= room)
        gap = best[room] - best[room - sizes[fits]] - worth[fits]
        k = int(np.argmin(gap))
        if gap[k] < 1e-9:
            counts[fits[k]] += 1
            room -= sizes[fits[k]]
        else:
            room -= 1
    return float(best[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations with the number of sequences each fills; they use no more pieces than there are."""
    k = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    amount = demand / np.diag(basis)
    for _ in range(12 * k):
        worth = np.linalg.solve(basis.T, np.ones(k))
        gain, column = _fill(sizes, worth, capacity)
        if gain <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        amount = np.maximum(amount - ratio[out] * step, 0)
        amount[out] = ratio[out]
        basis[:, out] = column
    left, found = demand.astype(np.int64).copy(), []
    for j in np.argsort(-(sizes @ basis)):
        column = basis[:, j].astype(np.int64)
        used = column > 0
        times = min(int(np.floor(amount[j] + 1e-6)), int((left[used] // column[used]).min()))
        if times > 0:
            found.append((column, times))
            left -= times * column
    return found


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first rank, count, first sequence, offset)``.

    Of the pieces of a length, that of rank ``first rank + i`` goes to sequence ``first sequence + i``.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    lengths = sorted((x for x in histogram if x < capacity), reverse=True)
    large = [x for x in lengths if x > capacity * LARGE]
    bins: list[tuple[int, int, int]] = []  # first sequence, count, room
    next_bin = 0

    total = sum(histogram[x] for x in large)
    if total:
        share = -(-total // groups)
        queues: list[list[list[int]]] = [[]]
        held = 0
        for x in large:
            rank, rest = 0, histogram[x]
            while rest:
                if held == share:
                    queues.append([])
                    held = 0
                n = min(rest, share - held)
                queues[-1].append([x, rank, n])
                rank, rest, held = rank + n, rest - n, held + n
        merged: dict[int, list[list[int]]] = {}
        for q in queues:  # groups that round up to the same size are one
            merged.setdefault(q[0][0], []).extend(q)
        sizes = np.array(sorted(merged, reverse=True))
        demand = np.array([sum(r[2] for r in merged[x]) for x in sizes.tolist()])
        for column, times in configurations(sizes, demand, capacity):
            parts = [(next_bin, times, 0)]  # first sequence, count, used
            next_bin += times
            for g in np.repeat(np.arange(len(sizes)), column).tolist():
                queue, after = merged[int(sizes[g])], []
                for first, count, used in parts:
                    while count:
                        run = queue[0]
                        n = min(count, run[2])
                        runs.append((run[0], run[1], n, first, used))
                        after.append((first, n, used + run[0]))
                        run[1], run[2] = run[1] + n, run[2] - n
                        if not run[2]:
                            queue.pop(0)
                        first, count = first + n, count - n
                parts = after
            bins += [(first, count, capacity - used) for first, count, used in parts]
        left = [tuple(r) for q in merged.values() for r in q]
    else:
        left = []

    rooms: list[int] = []
    by_room: dict[int, list[tuple[int, int]]] = {}

    def put(room: int, first: int, count: int) -> None:
        if room and room not in by_room:
            insort(rooms, room)
            by_room[room] = []
        if room:
            by_room[room].append((first, count))

    for first, count, room in bins:
        put(room, first, count)
    todo = left + [(x, 0, histogram[x]) for x in lengths if x <= capacity * LARGE]
    for x, rank, n in sorted(todo, key=lambda r: (-r[0], r[1])):
        while n:
            at = bisect_left(rooms, x)
            if at == len(rooms):
                fresh = -(-n // (capacity // x))
                put(capacity, next_bin, fresh)
                next_bin += fresh
                continue
            room = rooms[at]
            first, count = by_room[room].pop()
            k = min(n, count)
            if k < count:
                by_room[room].append((first + k, count - k))
            elif not by_room[room]:
                del by_room[room]
                rooms.pop(at)
            runs.append((x, rank, k, first, capacity - room))
            put(room - x, first, k)
            rank, n = rank + k, n - k
    if histogram.get(capacity):
        runs.append((capacity, 0, histogram[capacity], next_bin, 0))
    return runs


# --- pieces and places -----------------------------------------------------------------------------


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens: full ones after a first that may be shorter."""
    head = n % capacity or min(n, capacity)
    return [(0, head), *((at, capacity) for at in range(head, n, capacity))]


def _cut_texts(capacity: int, tokenizer: str, end_id: int, with_ids: bool, remembered: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.of(tokenizer, end_id)
        for part in c.slices(batches, "t"):
            row, rows, tokens = [], [], []
            for i, raw in enumerate(coder.encode(part.column("t"), remembered)):
                for k, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                    ids = raw[4 * start : 4 * (start + length)]
                    row.append(i)
                    rows.append((k, start, length, zlib.crc32(ids)))
                    tokens.append(ids)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            columns.insert(0, part.column("id").take(pa.array(row)))
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(tokens, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _ranked(pieces: DataFrame, blocks: int) -> DataFrame:
    """``rank`` of each piece among those of its length, from 0; the pieces of a length are ranked in blocks."""
    pieces = pieces.withColumn("block", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(blocks)))
    counts = pieces.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = counts.selectExpr(
        "length as l", "block as b", "sum(n) over (partition by length order by block) - n as before"
    )
    inside = F.expr("row_number() over (partition by length, block order by id, piece, ids_crc32)")
    ranked = pieces.withColumn("inside", inside)
    same = (F.col("length") == F.col("l")) & (F.col("block") == F.col("b"))
    return ranked.join(before, same).withColumn("rank", F.col("before") + F.col("inside") - 1).drop("l", "b", "before", "inside", "block")


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    with_ids: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32, sequence_id, offset`` of every piece, and its ids if wanted."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("t"))
    schema = f"id {kind}, {PIECE}" + (", ids binary" if with_ids else "")
    pieces = c.stored(texts.mapInArrow(_cut_texts(capacity, tokenizer, end_id, with_ids, remembered), schema), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = spark.createDataFrame(plan(histogram, capacity) or [], "l long, first_rank long, n long, first_sequence long, offset long")
    blocks = max(8, -(-max(histogram.values(), default=0) // RANK_ROWS))
    ranked = _ranked(pieces, blocks)
    here = (F.col("length") == F.col("l")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("n"))
    placed = ranked.join(F.broadcast(runs), here)  # the plan: its size does not grow with the documents
    sequence = F.col("first_sequence") + F.col("rank") - F.col("first_rank")
    out = [F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset"]
    return placed.select(*out, *(["ids"] if with_ids else []))


def op8_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(c.table(spark, sf_dir, "documents"))
