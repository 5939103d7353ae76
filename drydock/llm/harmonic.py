"""Harmonic packing of token sequences.

A length ``n`` belongs to the class of ``k = capacity // n``: a sequence of that class takes ``k`` pieces, so it is
complete as soon as ``k`` pieces of the length are there, whatever else is packed. Documents are cut so that only lengths
occur of which ``k`` leave at most ``slack`` tokens of a sequence: full pieces first, then time and again the longest such length.

Every worker fills the sequences of every class by itself. What is left of a class in a worker, fewer than ``k``
pieces, goes on to the next round, where ``FAN`` workers' pieces meet in one; a worker of any round holds less than
``FAN`` times the pieces of one sequence of each class. The one worker of the last round puts what then remains, less than
a sequence of each class, largest first into the sequence with the least room that fits.

Defined results: a null or empty text is one piece, the end id. Rows that repeat an id are packed each; a null id
is kept. Pieces of one length are alike, so ties change the places only. Extra columns do not matter; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .tokens import TOKENIZER, Coder

CAPACITY = 2048
END_ID = 1
#: Tokens of a complete sequence that may stay empty, for each 2,048 of its capacity.
SLACK = 8
#: Workers of one round whose pieces meet in a worker of the next one.
FAN = 8
#: Rounds that the numbers of sequences tell apart; enough for 8**15 workers.
ROUNDS = 16
PIECE = "start long, length long, ids_crc32 long, doc_tokens long"
PLACE = "sequence_id long, offset long, part int"


def class_lengths(capacity: int, slack: int) -> np.ndarray:
    """The lengths that pieces may have, ascending."""
    n = np.arange(1, capacity + 1)
    return n[capacity % n <= slack]


def cuts_by_rest(capacity: int, slack: int) -> list[list[int]]:
    """For each number of tokens below ``capacity`` the lengths of its pieces, longest first."""
    lengths = class_lengths(capacity, slack)
    out: list[list[int]] = [[]]
    for n in range(1, capacity):
        first = int(lengths[np.searchsorted(lengths, n, "right") - 1])
        out.append([first, *out[n - first]])
    return out


def fill(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """``(done, sequence, offset, sequences)``: the pieces of complete sequences, and their places there.

    Sequences are numbered from 0.
    """
    values, of, counts = np.unique(lengths, return_inverse=True, return_counts=True)
    order = np.argsort(of, kind="stable")
    first = np.cumsum(counts) - counts
    rank = np.empty(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths)) - first[of[order]]
    fit = capacity // np.maximum(values, 1)
    whole = counts // fit
    before = np.cumsum(whole) - whole
    done = np.flatnonzero(rank < (whole * fit)[of])
    k = of[done]
    return done, before[k] + rank[done] // fit[k], rank[done] % fit[k] * values[k], int(whole.sum())


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence, from 0, and offset of each piece: largest first, to the sequence with the least room that fits."""
    rooms: list[tuple[int, int]] = []
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    n = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        x = int(lengths[i])
        at = bisect_left(rooms, (x, -1))
        if at < len(rooms):
            room, to = rooms.pop(at)
        else:
            room, to, n = capacity, n, n + 1
        sequence[i], offset[i] = to, capacity - room
        if room > x:
            insort(rooms, (room - x, to))
    return sequence, offset


class _Worker:
    """Fills sequences from batches of pieces; gives complete ones out and holds the rest."""

    def __init__(self, capacity: int, round_: int, last: bool):
        self.capacity, self.last = capacity, last
        self.part = TaskContext.get().partitionId()
        self.number = (self.part * ROUNDS + round_) << 32
        self.held: pa.Table | None = None

    def _placed(self, pieces: pa.Table, sequence: np.ndarray | None, offset: np.ndarray | None) -> pa.Table:
        n = pieces.num_rows
        for name, values in (("sequence_id", sequence), ("offset", offset)):
            pieces = pieces.append_column(name, pa.nulls(n, pa.int64()) if values is None else pa.array(values, pa.int64()))
        return pieces.append_column("part", pa.array(np.full(n, self.part, np.int32)))

    def add(self, pieces: pa.Table) -> Iterator[pa.RecordBatch]:
        if self.held is not None:
            pieces = pa.concat_tables([self.held, pieces])
        done, sequence, offset, n = fill(pieces["length"].to_numpy(), self.capacity)
        rest = np.ones(pieces.num_rows, bool)
        rest[done] = False
        self.held = pieces.filter(pa.array(rest)).combine_chunks()
        yield from self._placed(pieces.take(pa.array(done)), self.number + sequence, offset).to_batches()
        self.number += n

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.held is None or not self.held.num_rows:
            return
        sequence = offset = None
        if self.last:
            sequence, offset = best_fit(self.held["length"].to_numpy(), self.capacity)
            sequence += self.number
        yield from self._placed(self.held, sequence, offset).to_batches()


def _first_round(capacity: int, slack: int, tokenizer: str, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, worker, rests = Coder.of(tokenizer, end_id), _Worker(capacity, 0, False), cuts_by_rest(capacity, slack)
        for part in c.slices(batches, "t"):
            row, rows, tokens = [], [], []
            for i, raw in enumerate(coder.encode(part.column("t"))):
                n, at = len(raw) // 4, 0
                for length in [capacity] * (n // capacity) + rests[n % capacity]:
                    ids = raw[4 * at : 4 * (at + length)]
                    row.append(i)
                    rows.append((at, length, zlib.crc32(ids), n))
                    if with_ids:
                        tokens.append(ids)
                    at += length
            columns = [part.column("id").take(pa.array(row)), *[pa.array(x, pa.int64()) for x in zip(*rows, strict=True)]]
            names = ["id", *(x.split()[0] for x in PIECE.split(", "))]
            if with_ids:
                columns.append(pa.array(tokens, pa.binary()))
                names.append("ids")
            yield from worker.add(pa.table(columns, names))
        yield from worker.close()

    return run


def _next_round(capacity: int, round_: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = _Worker(capacity, round_, last)
        for batch in batches:
            if batch.num_rows:
                yield from worker.add(pa.Table.from_batches([batch]))
        yield from worker.close()

    return run


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    slack: int | None = None,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    with_ids: bool = False,
    fan: int = FAN,
) -> DataFrame:
    """``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece, and its ids if wanted."""
    slack = SLACK * capacity // CAPACITY if slack is None else slack
    kind = docs.schema[id_col].dataType.simpleString()
    piece = f"id {kind}, {PIECE}" + (", ids binary" if with_ids else "")
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("t"))
    filled = texts.mapInArrow(_first_round(capacity, slack, tokenizer, end_id, with_ids), f"{piece}, {PLACE}")
    filled = c.stored(filled, "pieces")
    complete = [filled.filter("sequence_id is not null")]
    for round_ in range(1, ROUNDS):
        left = filled.filter("sequence_id is null")
        workers = (left.agg(F.max("part")).first()[0] or 0) // fan + 1
        met = left.drop("sequence_id", "offset").withColumn("part", (F.col("part") / fan).cast("int"))
        # A worker's pieces in one order, so that a task that is run again fills the same sequences.
        met = met.repartitionById(workers, F.col("part")).sortWithinPartitions("length", "id", "start", "ids_crc32").drop("part")
        filled = c.stored(met.mapInArrow(_next_round(capacity, round_, workers == 1), f"{piece}, {PLACE}"), "pieces")
        complete.append(filled.filter("sequence_id is not null"))
        if workers == 1:
            break
    out = complete[0]
    for more in complete[1:]:
        out = out.unionByName(more)
    names = [x.split()[0] for x in PIECE.split(", ")]
    return out.select(F.col("id").alias(id_col), *names, "sequence_id", "offset", *(["ids"] if with_ids else []))


def op11_harmonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(c.table(spark, sf_dir, "documents"))
