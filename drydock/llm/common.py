"""Helpers shared by the operators: table access, the shared work folder, and texts as flat arrays.

Words are the byte runs between the ASCII blanks ``\\x20 \\x09-\\x0D``. A batch of texts is one byte
buffer with row offsets, so words, hashes and windows come from whole-buffer numpy steps.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step handles; a longer single text makes a step of its own.
STEP_BYTES = 1 << 20
#: Texts that go to a Python worker at a time while a table is stored.
ARROW_ROWS = 2000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Shuffle files go as soon as the table that needed them is written.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PRIME = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a local session gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="drydock-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/drydock-{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it is computed once and survives lost executors."""
    spark = df.sparkSession
    folder = new_folder(spark, label)
    if _open:
        _open[-1].append(folder)
    rows = int(spark.conf.get(_ARROW_ROWS))
    before = spark.conf.get(_SHUFFLES_GO)
    spark.conf.set(_ARROW_ROWS, str(min(rows, ARROW_ROWS) if rows > 0 else ARROW_ROWS))
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(_ARROW_ROWS, str(rows))
        spark.conf.set(_SHUFFLES_GO, before)
    out = spark.read.schema(df.schema).parquet(folder)
    out._folder = folder
    return out


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Removes the files of ``stored`` tables that nothing reads any more."""
    for df in tables:
        _remove(df.sparkSession, df._folder)


#: Folders of the tables stored inside each open ``last_only``.
_open: list[list[str]] = []


def last_only(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``make`` gives, stored; the tables that were stored on the way are removed."""
    _open.append([])
    try:
        out = stored(make(), label)
    finally:
        folders = _open.pop()
    for folder in folders:
        if folder != out._folder:
            _remove(out.sparkSession, folder)
    return out


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold_of(column: str, n: int) -> Column:
    """``crc32(column as text) mod n``; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


#: Called when a task ends; what a worker remembers for tasks of one kind goes when it does another.
at_task_end: list[Callable[[], None]] = []


def give_back() -> None:
    """Returns freed memory to the system: workers stay for later stages, whose memory should not add up."""
    for forget in at_task_end:
        forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str, step: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``step`` bytes of text, and one row at least."""
    for batch in batches:
        col = batch.column(column)
        width = np.frombuffer(col.buffers()[1], np.int64 if pa.types.is_large_string(col.type) else np.int32)
        ends = width[col.offset : col.offset + len(col) + 1]
        at = 0
        while at < len(col):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + step, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
    give_back()


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(buffer, ends)``: the UTF-8 bytes of all rows, and the row limits; nulls are empty."""
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    ends = np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 65) & (buf <= 90), buf | 32, buf)


_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def spans(buf: np.ndarray, ends: np.ndarray, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, stops, first)``: the words of all rows, and the number of words before each row."""
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = ~blank[buf]
    limits = ends[1:-1]
    limits = limits[(limits > 0) & (limits < len(buf))]
    cut = np.zeros(len(buf) + 1, bool)
    cut[limits] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    stops = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return starts, stops, np.searchsorted(starts, ends)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


_powers = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``p**0..p**n`` and their inverses modulo 2**64, as far as any call has needed them."""
    if len(_powers[0]) <= n:
        size = 1 << (n + 1).bit_length()
        inverse = _U(pow(int(_PRIME), -1, 1 << 64))
        with np.errstate(over="ignore"):
            for k, base in enumerate((_PRIME, inverse)):
                out = np.full(size, base, np.uint64)
                out[0] = 1
                _powers[k] = np.multiply.accumulate(out)
    return _powers[0], _powers[1]


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Sums of ``(byte + 1) * p**place`` before each place, modulo 2**64."""
    up, _ = powers(len(buf))
    total = np.zeros(len(buf) + 1, np.uint64)
    terms = buf.astype(np.uint64)
    terms += _U(1)
    terms *= up[: len(buf)]
    np.cumsum(terms, out=total[1:])
    return total


#: Longest span that is hashed as one; longer ones are hashes of the hashes of such pieces.
PIECE = 128


def span_hashes(buf: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: its length, then eight bytes at a time, mixed in one after the other."""
    size = stops - starts
    out = size.astype(np.uint64) * _U(0xD6E8FEB86659FD93)
    if not len(size):
        return out
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(buf) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    long = np.flatnonzero(size > PIECE)
    which, at, left = np.flatnonzero(size <= PIECE) if len(long) else None, starts, size
    if which is not None:
        at, left = at[which], left[which]
    while which is None or len(which):
        word = eight[at]
        end = np.flatnonzero(left < 8)
        word[end] &= (_U(1) << (left[end].astype(np.uint64) << _U(3))) - _U(1)
        if which is None:
            out = mix(out * _PRIME + word)
            which = np.arange(len(at))
        else:
            out[which] = mix(out[which] * _PRIME + word)
        more = np.flatnonzero(left > 8)
        which, at, left = which[more], at[more] + 8, left[more] - 8
    if len(long):
        n = -(-size[long] // PIECE)
        ends = np.cumsum(n)
        first = np.repeat(starts[long], n) + (np.arange(ends[-1]) - np.repeat(ends - n, n)) * PIECE
        pieces = span_hashes(buf, first, np.minimum(first + PIECE, np.repeat(stops[long], n)))
        out[long] = mix(out[long] * _PRIME + span_hashes(pieces.view(np.uint8), 8 * (ends - n), 8 * ends))
    return out


def short_hashes(buf: np.ndarray, starts: np.ndarray, stops: np.ndarray, total: np.ndarray) -> np.ndarray:
    """As ``span_hashes``, by one polynomial modulo 2**64 from ``prefix_sums``: for spans of some characters, or beside the other."""
    _, down = powers(len(buf))
    return mix((total[stops] - total[starts]) * down[starts] + (stops - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def windows(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside a row, in order, and the number of runs before each row.

    A row with fewer words, but one at least, has one run: all its words.
    """
    counts = np.diff(first)
    runs = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    before = np.concatenate([[0], np.cumsum(runs)])
    row = np.repeat(np.arange(len(counts)), runs)
    at = np.arange(before[-1]) - before[row] + first[row]
    out = np.zeros(len(at), np.uint64)
    limit = first[row + 1] if len(row) else at
    for k in range(n):
        pos = at + k
        ok = pos < limit
        part = h[np.minimum(pos, max(len(h) - 1, 0))] if len(h) else h
        out = np.where(ok, mix(out * _PRIME + part + _U(k + 1)), out)
    return out, before


def distinct_in_rows(values: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of each row, and the new row limits."""
    row = np.repeat(np.arange(len(before) - 1), np.diff(before))
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    v, r = v[keep], r[keep]
    return v, np.searchsorted(r, np.arange(len(before)))


def hashed_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the lowest hashes of ``key``; the same ones however ``df`` is partitioned.

    A cut of the hash range that leaves about a tenth more than ``rows`` comes first, so little is sorted.
    """
    total = df.count()
    mark = F.xxhash64(F.col(key).cast("string"), F.lit("sample"))
    share = min(1.0, (1.1 * rows + 100) / max(total, 1))
    low = df.withColumn("_h", F.pmod(mark, F.lit(1 << 40))).filter(F.col("_h") < int(share * (1 << 40)))
    return low.orderBy("_h", F.col(key)).limit(rows).drop("_h")
