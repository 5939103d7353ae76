"""Quality classifier: a generalised additive model with pairwise interactions.

A text has a row of features (shares, means and logarithms of counts). Each feature is cut into bins, and has
a table with one score per bin; chosen pairs of features have a table over coarse bins of both. Cyclic
boosting goes round the features many times: a shallow tree over a feature's bins is fitted to what the
model so far leaves, and added to its table at a small rate. The pairs follow in the same way, with trees of one
cut on each side. A score is the logistic of a sum of table entries.

The tables are fitted in one task on the features of at most ``SAMPLE_ROWS`` labelled rows.

Defined results: a null or empty text has features like any other, all zero, and a score. Without training rows, or with
one class only, the score is the smoothed share of class 1. Rows are scored alone: repeated rows get equal results, extra
columns do not matter, an empty table gives an empty result. Of an id labelled more than once each label counts; a label without a
document, or a null label, is left out.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .quality_rules import base_counts

SAMPLE_ROWS = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS = 120, 40
RATE = 0.1
PAIRS = 8
LEAST_WEIGHT = 5.0
THRESHOLD = 0.3

FEATURES = (
    "bytes", "words", "lines", "word_length", "line_words", "blank", "upper", "digit", "stop_mark", "exclaim", "symbol", "bar",
    "other_mark", "not_ascii", "shouted", "capital", "marked", "short", "distinct", "repeated", "twice",
)

_CLASS = np.zeros(256, np.uint8)  # by byte: 0 other letters and bytes
for _k, _set in enumerate((b" \t\n\v\f\r", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?", b"!", b"#*$%&<>", b"|", b"\"'()[]{}-_/\\+=@^~`"), 1):
    _CLASS[list(_set)] = _k
_CLASS[128:] = 9


def _per_row(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[ends]).astype(float)


def features(col: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    buf, ends = c.text_bytes(col)
    kind = _CLASS[buf]
    size = np.diff(ends).astype(float)
    starts, stops, first = c.spans(buf, ends)
    words = np.diff(first).astype(float)
    by = [_per_row(kind == k, ends) for k in range(10)]
    lines = _per_row(buf == 10, ends) + (size > 0)
    upper = np.concatenate([[0], np.cumsum(kind == 1)])
    letters = np.concatenate([[0], np.cumsum((kind <= 1) | (kind == 9))])
    caps, all_letters = upper[stops] - upper[starts], letters[stops] - letters[starts]
    last = kind[stops - 1] if len(stops) else kind[:0]
    head = kind[starts] if len(starts) else kind[:0]
    base = base_counts(col)
    distinct = np.diff(c.distinct_in_rows(c.span_hashes(buf, starts, stops), first)[1]).astype(float)
    some, text = np.maximum(words, 1), np.maximum(size, 1)
    return np.stack(
        [
            np.log1p(size),
            np.log1p(words),
            np.log1p(lines),
            base["word_chars"] / some,
            np.log1p(words / np.maximum(lines, 1)),
            *(by[k] / text for k in range(1, 10)),
            _per_row((caps > 1) & (caps == all_letters), first) / some,
            _per_row(head == 1, first) / some,
            _per_row((last >= 5) & (last <= 8), first) / some,
            _per_row(stops - starts <= 2, first) / some,
            distinct / some,
            base["n_repeat_words"] / some,
            base["n_dup_lines"] / np.maximum(lines, 1),
        ],
        axis=1,
    )


# --- the model ---------------------------------------------------------------------------------------


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """The cut of a run of bins that lowers the loss most, and by how much."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    ok = (hl >= LEAST_WEIGHT / 4) & (hr >= LEAST_WEIGHT / 4)
    gain = np.where(ok, gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1), 0)
    k = int(np.argmax(gain)) if len(gain) else 0
    return k + 1, float(gain[k]) if len(gain) else 0.0


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Newton steps of a tree over ordered bins, one value per bin."""
    at, gain = _best_cut(g, h)
    if depth == 0 or gain <= 1e-9:
        return np.full(len(g), -g.sum() / (h.sum() + 1))
    return np.concatenate([shallow_tree(g[:at], h[:at], depth - 1), shallow_tree(g[at:], h[at:], depth - 1)])


def quadrants(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Newton steps of the best tree with one cut on each side of a grid, and its gain."""
    best, out = 0.0, np.zeros(g.shape)
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    for i in range(g.shape[0] - 1):
        for j in range(g.shape[1] - 1):
            parts = []
            for c_ in (cg, ch):
                a, row, col, full = c_[i, j], c_[i, -1], c_[-1, j], c_[-1, -1]
                parts.append(np.array([a, row - a, col - a, full - row - col + a]))
            gain = float((parts[0] ** 2 / (parts[1] + 1)).sum() - cg[-1, -1] ** 2 / (ch[-1, -1] + 1))
            if gain > best:
                best, step = gain, -parts[0] / (parts[1] + 1)
                out = np.empty(g.shape)
                out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = step
    return out, best


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    def __init__(self, base: float, cuts: list[np.ndarray], coarse: list[np.ndarray], tables: np.ndarray, pairs: list[tuple[int, int]], grids: np.ndarray):
        self.base, self.cuts, self.coarse, self.tables, self.pairs, self.grids = base, cuts, coarse, tables, pairs, grids

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for k, cuts in enumerate(self.cuts):
            out += self.tables[k][np.searchsorted(cuts, x[:, k], "right")]
        for (i, j), grid in zip(self.pairs, self.grids, strict=True):
            out += grid[np.searchsorted(self.coarse[i], x[:, i], "right"), np.searchsorted(self.coarse[j], x[:, j], "right")]
        return sigmoid(out)


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    found = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))
    return found[found > values.min()]


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Features whose values do not differ get an empty table."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    n = x.shape[1]
    if not 0 < y.sum() < len(y):
        return Model(base, [np.zeros(0)] * n, [np.zeros(0)] * n, np.zeros((n, 1)), [], np.zeros((0, 1, 1)))
    cuts = [_cuts(x[:, k], BINS) for k in range(n)]
    coarse = [_cuts(x[:, k], PAIR_BINS) for k in range(n)]
    fine = [np.searchsorted(cuts[k], x[:, k], "right") for k in range(n)]
    rough = [np.searchsorted(coarse[k], x[:, k], "right") for k in range(n)]
    tables, out = np.zeros((n, BINS)), np.full(len(y), base)
    for _ in range(ROUNDS):
        for k in range(n):
            p = sigmoid(out)
            size = len(cuts[k]) + 1
            g, h = np.bincount(fine[k], p - y, size), np.bincount(fine[k], p * (1 - p), size)
            step = RATE * shallow_tree(g, h)
            tables[k, :size] += step
            out += step[fine[k]]

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p, shape = sigmoid(out), (len(coarse[i]) + 1, len(coarse[j]) + 1)
        cell = rough[i] * shape[1] + rough[j]
        return tuple(np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in (p - y, p * (1 - p)))

    gains = sorted(((quadrants(*sums(i, j))[1], i, j) for i in range(n) for j in range(i)), reverse=True)
    pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
    grids = np.zeros((len(pairs), PAIR_BINS, PAIR_BINS))
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(pairs):
            step = RATE * quadrants(*sums(i, j))[0]
            grids[k, : step.shape[0], : step.shape[1]] += step
            out += step[rough[i], rough[j]]
    return Model(base, cuts, coarse, tables, pairs, grids)


# --- as Spark jobs ------------------------------------------------------------------------------------


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *also: Column) -> DataFrame:
    """``id_col``, the columns of ``also`` and ``features`` of every row: one pass over the texts."""
    rows = docs.select(docs[id_col].alias("i"), *also, docs[text_col].cast("string").alias("t"))
    kept = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in c.slices(batches, "t"):
            x = features(part.column("t"))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in kept), lists], [*kept, "features"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, features array<double>").withColumnRenamed("i", id_col)


def train(rows: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE_ROWS) -> Model:
    """Fits the tables on rows with ``features`` and a 0/1 label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), pa.schema([("k", pa.string()), ("x", pa.list_(pa.float64())), ("y", pa.int32())]))
        x = np.array(table.column("x").to_pylist(), float).reshape(table.num_rows, len(FEATURES))
        model = fit(x, np.array(table.column("y").to_pylist(), float))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model.__dict__)], pa.binary())], ["model"])

    known = rows.select(rows[id_col].cast("string").alias("k"), F.col("features").alias("x"), F.col(label_col).cast("int").alias("y"))
    fitted = c.hashed_sample(known.filter("y in (0, 1)"), "k", sample).coalesce(1).mapInArrow(run, "model binary").first()
    fields = pickle.loads(fitted["model"]) if fitted else fit(np.zeros((0, len(FEATURES))), np.zeros(0)).__dict__
    return Model(**fields)


def scored(rows: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``rows`` with ``score`` and ``predicted`` in place of ``features``."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    kept = [x for x in rows.columns if x != "features"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            score = sent.value.score(x)
            columns = [pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *columns], [*kept, "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "features")
    return rows.mapInArrow(run, f"{schema}, score double, predicted int")


def op7_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = c.fold_of("doc_id", 5) == 0
    rows = c.stored(featured(c.table(spark, sf_dir, "documents"), "doc_id", "text", held.alias("held_out")), "features")
    labels = c.table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = train(rows.filter("not held_out").join(labels, "doc_id"))
    return scored(rows, model)
