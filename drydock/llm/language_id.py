"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is its runs of ``GRAMS`` bytes (letters in lower case, everything else a blank), hashed into
buckets. A bucket has a small embedding; their mean goes through a linear softmax. Both are trained by
stochastic gradient descent in numpy, in one task, on the bucket counts of a sample of at most ``SAMPLE_ROWS`` rows, of any
length: the texts are counted where they are. A fifth of the sample sets the temperature that calibrates the probabilities, and the
probability below which a prediction is rejected: the least at which ``ACCEPTED`` of the accepted ones are right.

As the mean comes before a linear map, scoring needs one row of class scores per bucket, added up over
the whole text.

Defined results: a null text, or one without a letter (Unicode category L), is ``und`` with score 0, and rejected. Without training rows
every text is ``und``. Ties go to the language first in order. Each row is scored alone; repeated rows get equal results, extra
columns do not matter, an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

GRAMS = (2, 3, 4)
BUCKETS = 1 << 15
SIZE = 16
EPOCHS = 6
RATE = 0.5
BATCH = 32
SAMPLE_ROWS = 6000
ACCEPTED = 0.99
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
for _b in range(65, 91):
    _FOLD[_b] = _FOLD[_b + 32] = _b + 32
_FOLD[128:] = np.arange(128, 256)
_MAYBE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether a character is of Unicode category L; numerals such as fractions and circled digits are not."""
    return any(unicodedata.category(m.group())[0] == "L" for m in _MAYBE_LETTER.finditer(text))


def grams(buf: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """The bucket at every place, for each size of run; ``BUCKETS`` where a run would leave its row."""
    text = _FOLD[buf].astype(np.uint32)
    left = np.repeat(ends[1:], np.diff(ends)) - np.arange(len(buf))
    for n in GRAMS:
        key = np.full(len(buf), n, np.uint32)
        for k in range(n):
            m = max(len(buf) - k, 0)
            key[:m] = key[:m] * np.uint32(0x01000193) ^ text[k:] * np.uint32(0x9E3779B1)
        key ^= key >> np.uint32(15)
        key *= np.uint32(0x85EBCA6B)
        out = (key >> np.uint32(32 - 15)).astype(np.int32)
        out[left < n] = BUCKETS
        yield out


class Model:
    """Class scores per bucket, and the calibration."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float = 1.0, least: float = 0.0):
        self.languages, self.table, self.bias, self.temperature, self.least = languages, table, bias, temperature, least

    def logits(self, col: pa.Array) -> np.ndarray:
        buf, ends = c.text_bytes(col)
        n = len(ends) - 1
        sums = np.zeros((n, len(self.languages)))
        used = np.zeros(n)
        full = np.flatnonzero(np.diff(ends))
        if len(full):
            for at in grams(buf, ends):
                sums[full] += np.add.reduceat(self.table[at], ends[full], axis=0)
                used[full] += np.add.reduceat((at < BUCKETS).astype(np.int64), ends[full])
        return sums / np.maximum(used, 1)[:, None] + self.bias

    def predict(self, col: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, calibrated probability, and whether the prediction is rejected."""
        known = np.array([bool(t) and has_letter(t) for t in col.to_pylist()])
        if not self.languages:
            return [UNKNOWN] * len(col), np.zeros(len(col)), np.ones(len(col), bool)
        p = softmax(self.logits(col) / self.temperature)
        best = p.argmax(axis=1)
        score = np.where(known, p[np.arange(len(p)), best], 0.0)
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
        return names, score, ~known | (score < self.least)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


NO_FEATURES = np.zeros(0, np.int32), np.zeros(0), np.zeros(1, np.int64)


def _features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct buckets of each text, their shares, and the limits of the texts."""
    idx, share, limits = [], [], [0]
    for k in range(len(texts)):
        buf, ends = c.text_bytes(texts.slice(k, 1))
        counts = np.zeros(BUCKETS + 1, np.int64)
        for g in grams(buf, ends):
            counts += np.bincount(g, minlength=BUCKETS + 1)
        b = np.flatnonzero(counts[:BUCKETS])
        idx.append(b.astype(np.int32))
        share.append(counts[b] / max(counts[b].sum(), 1))
        limits.append(limits[-1] + len(b))
    return np.concatenate(idx), np.concatenate(share), np.array(limits)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``k, l, b, n``: key, label and the bucket counts of each whole text, a row of bounded size however long the text is."""
    for part in c.slices(batches, "t", 1 << 20):
        b, n, limits = _features(part.column("t"))
        columns = [part.column("k"), part.column("l")]
        offsets = pa.array(limits, pa.int32())
        columns += [pa.ListArray.from_arrays(offsets, pa.array(b)), pa.ListArray.from_arrays(offsets, pa.array(n))]
        yield pa.RecordBatch.from_arrays(columns, ["k", "l", "b", "n"])


def fit(texts: pa.Array, labels: list[str], seed: int = 1) -> Model:
    return fit_features(_features(texts) if len(texts) else NO_FEATURES, labels, seed)


def fit_features(features: tuple[np.ndarray, np.ndarray, np.ndarray], labels: list[str], seed: int = 1) -> Model:
    """``features``: buckets, shares and limits of the labelled texts."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0))
    target = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    idx, share, limits = features
    size = np.diff(limits)
    rows = rng.permutation(np.flatnonzero(size))
    held, rows = rows[: len(rows) // 5], rows[len(rows) // 5 :]
    embed = rng.normal(0, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32)
    weight, bias = np.zeros((SIZE, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    steps, done = max(1, EPOCHS * -(-len(rows) // BATCH)), 0
    for _ in range(EPOCHS):
        for start in range(0, len(rows), BATCH):
            part = rows[start : start + BATCH]
            rate = RATE * (1 - done / steps)
            done += 1
            at = np.concatenate([np.arange(limits[r], limits[r + 1]) for r in part])
            first = np.concatenate([[0], np.cumsum(size[part])[:-1]])
            b, s = idx[at], share[at].astype(np.float32)[:, None]
            hidden = np.add.reduceat(embed[b] * s, first, axis=0)
            error = softmax(hidden @ weight + bias)
            error[np.arange(len(part)), target[part]] -= 1
            back = (error @ weight.T).astype(np.float32)
            weight -= rate * hidden.T @ error
            bias -= rate / len(part) * error.sum(axis=0)
            order = np.argsort(b, kind="stable")
            heads = np.flatnonzero(np.diff(b[order], prepend=-1))
            grad = np.add.reduceat((np.repeat(back, size[part], axis=0) * s)[order], heads, axis=0)
            embed[b[order][heads]] -= 20 * rate * grad  # a bucket's share is small, so its step is not
    table = np.zeros((BUCKETS + 1, len(languages)), np.float32)
    table[:-1] = embed @ weight
    model = Model(languages, table, bias)
    if len(held):
        sums = np.add.reduceat(table[np.concatenate([idx[limits[r] : limits[r + 1]] for r in held])] * np.concatenate([share[limits[r] : limits[r + 1]] for r in held])[:, None], np.cumsum(size[held]) - size[held], axis=0)
        logits, want = sums + bias, target[held]
        grid = np.exp(np.linspace(-4, 2, 61))
        loss = [-np.log(softmax(logits / t)[np.arange(len(held)), want] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = softmax(logits / model.temperature)
        score, right = p.max(axis=1), p.argmax(axis=1) == want
        order = np.argsort(-score)
        share_right = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(share_right >= ACCEPTED)
        model.least = float(score[order][good[-1]]) if len(good) else 1.0
    return model


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int = SAMPLE_ROWS) -> Model:
    """Fits in one task on a bounded sample of the labelled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx, share, limits, labels = [np.zeros(0, np.int32)], [np.zeros(0)], [np.zeros(1, np.int64)], []
        for batch in batches:
            b, n = batch.column("b"), batch.column("n")
            idx.append(b.flatten().to_numpy())
            share.append(n.flatten().to_numpy())
            limits.append(limits[-1][-1] + np.cumsum(b.value_lengths().to_numpy()))
            labels += batch.column("l").to_pylist()
        model = fit_features((np.concatenate(idx), np.concatenate(share), np.concatenate(limits)), labels)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model.__dict__)], pa.binary())], ["model"])

    known = docs.select(docs[id_col].cast("string").alias("k"), docs[text_col].cast("string").alias("t"), docs[lang_col].cast("string").alias("l"))
    known = known.filter((F.octet_length("t") > 0) & F.col("l").isNotNull())
    # The sample is chosen by key, then counted where the texts are: whole texts of any length never leave their tasks.
    chosen = c.hashed_sample(known.select("k"), "k", rows).select(F.col("k").alias("chosen"))
    some = known.join(F.broadcast(chosen.distinct()), F.col("k").eqNullSafe(F.col("chosen"))).select("k", "l", "t")
    counted = some.mapInArrow(_counted, "k string, l string, b array<int>, n array<double>")
    counted = counted.groupBy("k").agg(F.min(F.struct("l", "b", "n")).alias("row")).select("row.*")  # one row an id, however often it repeats
    fitted = counted.coalesce(1).mapInArrow(run, "model binary").first()
    fields = pickle.loads(fitted["model"]) if fitted else fit_features(NO_FEATURES, []).__dict__
    return Model(**fields)


def predictions(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *also: Column) -> DataFrame:
    """``id_col``, the columns of ``also``, ``lang_pred, score, rejected`` of every row: one pass, no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(docs[id_col].alias("i"), *also, docs[text_col].cast("string").alias("t"))
    kept = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in c.slices(batches, "t", 1 << 20):
            names, score, rejected = sent.value.predict(part.column("t"))
            columns = [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*(part.column(x) for x in kept), *columns], [*kept, "lang_pred", "score", "rejected"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double, rejected boolean").withColumnRenamed("i", id_col)


def op6_subword_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = c.table(spark, sf_dir, "documents")
    held = c.fold_of("doc_id", 3) == 1
    model = train(docs.filter(~held), "doc_id", "text", "lang")
    return predictions(docs, model, "doc_id", "text", held.alias("held_out"))
