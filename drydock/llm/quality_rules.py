"""Quality rules: compression bands.

A text is measured by its zstandard ratio (compressed bytes over bytes), whole and in fixed chunks.
Repetitive text lies below the band of its length, random or encoded text above it. Short texts
compress less, so each length has its own limits. The chunks cover every byte: the last chunk is the last ``CHUNK``
bytes of the text, and a text shorter than that is one chunk with the limits of its length.

Defined results: a null or empty text has no words, zero counts, a null ratio, ``base_failed`` and is not
kept. Each row is judged alone: repeated rows get equal results, extra columns do not matter, an
empty table gives an empty result. A text of any length is measured whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common as c

#: (bytes below, least ratio, most ratio) of whole texts.
BANDS = (
    (128, 0.0, 9.0),
    (256, 0.42, 1.00),
    (512, 0.40, 0.95),
    (1024, 0.36, 0.85),
    (2048, 0.34, 0.78),
    (4096, 0.32, 0.72),
    (8192, 0.30, 0.68),
    (16384, 0.28, 0.65),
    (1 << 62, 0.25, 0.62),
)
CHUNK = 2048
#: The same of chunks. The upper limits lie between clean text and base64 (at 2,048 bytes 0.53 and 0.77 at the outside).
CHUNK_BANDS = (
    (128, 0.0, 9.0),
    (256, 0.25, 0.95),
    (512, 0.25, 0.80),
    (1024, 0.25, 0.75),
    (2048, 0.25, 0.68),
    (1 << 62, 0.25, 0.66),
)
#: Share of chunks outside their band above which a text is rejected.
BAD_CHUNKS = 0.25
LEVEL = 3
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of words in repeated windows
WINDOW = 8

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "ratio double, n_chunks long, n_bad_chunks long, kept boolean"
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _sums(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[ends])


def _line_spans(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, stops and row of all lines."""
    breaks = np.flatnonzero(buf == 10)
    starts = np.sort(np.concatenate([ends[:-1], breaks + 1]), kind="stable")
    stops = np.sort(np.concatenate([breaks, ends[1:]]), kind="stable")
    # Starts and stops pair up in order: each row gives one more start than breaks, and as many stops.
    rows = np.repeat(np.arange(len(ends) - 1), np.diff(np.searchsorted(breaks, ends)) + 1)
    return starts, stops, rows


def base_counts(col: pa.Array, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Word, symbol, repeated-line and repeated-window counts of each text."""
    buf, ends = c.text_bytes(col)
    n = len(ends) - 1
    starts, stops, first = c.spans(buf, ends)
    words = np.diff(first)
    out = {
        "n_words": words,
        "word_chars": _sums(((buf & 0xC0) != 0x80) & ~c._BLANK[buf], ends),
        "n_symbols": _sums(_SYMBOL[buf], ends),
    }
    ls, le, rows = _line_spans(buf, ends)
    worded = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    ls, le, rows = ls[worded], le[worded], rows[worded]
    _, limits = c.distinct_in_rows(c.span_hashes(buf, ls, le), np.searchsorted(rows, np.arange(n + 1)))
    out["n_dup_lines"] = np.bincount(rows, minlength=n) - np.diff(limits)

    runs, before = c.windows(c.span_hashes(buf, starts, stops), first, window)
    row = np.repeat(np.arange(n), np.diff(before))
    order = np.lexsort((runs, row))
    v, r = runs[order], row[order]
    same = (v[1:] == v[:-1]) & (r[1:] == r[:-1]) if len(v) else np.zeros(0, bool)
    twice = np.zeros(len(v), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(len(v), bool)
    hit[order] = twice
    at = np.flatnonzero(hit)
    word = at - before[row[at]] + first[row[at]]
    change = np.zeros(len(starts) + window + 1, np.int64)
    np.add.at(change, word, 1)
    np.add.at(change, word + window, -1)
    out["n_repeat_words"] = _sums(np.cumsum(change)[: len(starts)] > 0, first)
    return out


def band_of(n_bytes: int, bands: tuple[tuple[int, float, float], ...] = BANDS) -> tuple[float, float]:
    return next((low, high) for below, low, high in bands if n_bytes < below)


def chunk_starts(n_bytes: int) -> list[int]:
    """Where the chunks of a text start; the last one ends with the text."""
    starts = list(range(0, n_bytes - CHUNK + 1, CHUNK))
    if n_bytes % CHUNK:
        starts.append(max(n_bytes - CHUNK, 0))
    return starts


def measure(col: pa.Array) -> pa.RecordBatch:
    """All columns of ``SCHEMA`` for a column of texts."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False).compress
    base = base_counts(col)
    failed = (base["n_words"] < LEAST_WORDS) | (100 * base["n_repeat_words"] > MOST_REPEATED * base["n_words"])
    buf, ends = c.text_bytes(col)
    raw = memoryview(np.ascontiguousarray(buf))
    ratios, chunks, bad, kept = [], [], [], []
    for i in range(len(col)):
        text = raw[ends[i] : ends[i + 1]]
        n = len(text)
        ratio = len(pack(text)) / n if n else None
        size = min(n, CHUNK)
        low, high = band_of(size, CHUNK_BANDS)
        starts = chunk_starts(n)
        parts = [ratio] if 0 < n <= CHUNK else [len(pack(text[k : k + CHUNK])) / size for k in starts]
        outside = sum(not low <= x <= high for x in parts)
        least, most = band_of(n)
        ratios.append(ratio)
        chunks.append(len(starts))
        bad.append(outside)
        kept.append(ratio is not None and least <= ratio <= most and outside <= BAD_CHUNKS * len(starts))
    columns = {k: pa.array(v, pa.int64()) for k, v in base.items()}
    columns["base_failed"] = pa.array(failed, pa.bool_())
    columns["ratio"] = pa.array(ratios, pa.float64())
    columns["n_chunks"] = pa.array(chunks, pa.int64())
    columns["n_bad_chunks"] = pa.array(bad, pa.int64())
    columns["kept"] = pa.array(np.array(kept, bool) & ~failed, pa.bool_())
    return pa.RecordBatch.from_pydict(columns)


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the columns of ``SCHEMA`` for every row: one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in c.slices(batches, "t"):
            got = measure(part.column("t"))
            yield pa.RecordBatch.from_arrays([part.column("i"), *got.columns], ["i", *got.schema.names])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("i"), docs[text_col].cast("string").alias("t"))
    return rows.mapInArrow(run, f"i {kind}, {SCHEMA}").withColumnRenamed("i", id_col)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the rules, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in c.slices(batches, text_col):
            yield part.filter(measure(part.column(text_col)).column("kept"))

    return docs.mapInArrow(run, docs.schema)


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(c.table(spark, sf_dir, "documents"))
