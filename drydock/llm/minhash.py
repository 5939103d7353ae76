"""Near-duplicate documents by circulant MinHash.

A document is the set of its word shingles (ASCII letters in lower case; words between ASCII blanks).
Two permutations of the 32-bit universe make all coordinates: one renames a shingle, the other,
shifted circularly by one place more for each coordinate, orders it. Bands of coordinates give
buckets, candidates are confirmed on full sets, and links are joined to components.

Documents with one and the same set are first folded into one, so exact copies cost one row each. Bands
of 5 in 30 miss a pair at similarity 0.8 about once in 150,000, at 0.9 practically never. Shingles are compared by 64-bit hashes.

Defined results: a null or blank text has no shingles and is linked with nothing; a text with fewer words
than a shingle has one shingle, all its words. A null id is linked with nothing, its component is null and
it is kept. Rows that repeat an id count as one document. Ties in similarity at the threshold are links.
Extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from . import common as c
from . import linkage

BANDS, ROWS = 30, 5
SHINGLE = 5
#: Least similarity in per cent.
SIMILAR = 80
_V = np.uint32


def _shuffle32(x: np.ndarray, spare: np.ndarray) -> None:
    """A permutation of 32-bit words, in place."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        np.right_shift(x, _V(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, _V(factor), out=x)
    np.right_shift(x, _V(16), out=spare)
    np.bitwise_xor(x, spare, out=x)


def circulant(values: np.ndarray, before: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash coordinates of each row that has values, in a row of the result; 64-bit values."""
    full = np.flatnonzero(np.diff(before))
    sigma = (values & c._U(0xFFFFFFFF)).astype(np.uint32) ^ _V(0x5BD1E995)
    work, spare = np.empty_like(sigma), np.empty_like(sigma)
    _shuffle32(sigma, spare)
    out = np.empty((len(full), n), np.uint32)
    if len(full):
        starts = before[full]
        for k in range(n):
            np.subtract(sigma, _V(k), out=work)  # circular: modulo 2**32
            _shuffle32(work, spare)
            out[:, k] = np.minimum.reduceat(work, starts)
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit bucket key per band; keys of different bands differ."""
    parts = signature.reshape(len(signature), -1, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(rows):
        key = c.mix(key * c._PRIME + parts[:, :, k])
    return key.view(np.int64)


def shingle_sets(col: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, and the row limits."""
    buf, ends = c.text_bytes(col)
    buf = c.lower_ascii(buf)
    starts, stops, first = c.spans(buf, ends)
    return c.distinct_in_rows(*c.windows(c.span_hashes(buf, starts, stops), first, n))


def _signatures(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in c.slices(batches, "t"):
            v, before = shingle_sets(part.column("t"), n)
            size = np.diff(before)
            full = np.flatnonzero(size)
            keys = np.zeros((len(size), 2), np.int64)
            lists: list = [None] * len(size)
            sketches = np.zeros(len(size), np.int64)
            if len(full):
                for k, x in enumerate((v, c.mix(v ^ c._PRIME))):
                    keys[full, k] = np.add.reduceat(x, before[full]).view(np.int64)
                coordinates = circulant(v, before, max(bands * rows, linkage.SKETCH))
                sketches[full] = linkage.sketch_bits(coordinates).view(np.int64)
                for i, row in zip(full, band_keys(coordinates[:, : bands * rows], rows), strict=True):
                    lists[i] = row
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(size, pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(lists, pa.list_(pa.int64())), pa.array(sketches)],
                ["id", "n", "k1", "k2", "bands", "sketch"],
            )

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in c.slices(batches, "t"):
            v, before = shingle_sets(part.column("t"), n)
            signed, _ = c.distinct_in_rows(v.view(np.int64), before)
            lists = pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(signed))
            yield pa.RecordBatch.from_arrays([part.column("id"), lists], ["id", "s"])

    return run


def stored_sets(column: pa.Array) -> list[np.ndarray]:
    return [x.values.to_numpy() for x in column]


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = SIMILAR,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` for every row."""
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("t"))
    kind = docs.schema[id_col].dataType.simpleString()
    signed = c.stored(
        texts.mapInArrow(_signatures(shingle, bands, rows), f"id {kind}, n long, k1 long, k2 long, bands array<long>, sketch long"), "signatures"
    )
    usable = signed.filter("id is not null and n > 0")
    # Integers number the items as they are; other ids get numbers, and a component's smallest id is found at the end.
    whole = isinstance(docs.schema[id_col].dataType, IntegralType)
    folded = usable.groupBy("n", "k1", "k2").agg(F.min("id").alias("rep"), F.min("bands").alias("bands"), F.min("sketch").alias("sketch"))
    folded = c.stored(folded.withColumn("item", F.col("rep").cast("long")) if whole else folded, "folded")
    wide, signed = signed, c.stored(signed.drop("bands", "sketch"), "sizes")
    numbers = c.stored(folded.select("rep").distinct().withColumn("item", F.col("rep").cast("long") if whole else F.monotonically_increasing_id()), "numbers")
    members = folded if whole else folded.join(numbers, "rep")
    reps = c.stored(folded.select("n", "k1", "k2", "rep"), "copies")
    c.discard(wide)

    def prepare(ids: DataFrame):
        names = ids if whole else numbers.join(ids, F.col("item") == F.col("id")).select(F.col("rep").alias("id"))
        sets = linkage.maybe_in(texts, "id", names).mapInArrow(_sets(shingle), f"id {kind}, s array<long>")
        if whole:
            sets = sets.withColumn("id", F.col("id").cast("long"))
        else:
            sets = sets.join(numbers, F.col("id") == F.col("rep")).select(F.col("item").alias("id"), "s")
        sets = c.stored(sets, "sets")

        def similar(pairs: DataFrame) -> DataFrame:
            both = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
            both = both.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
            small, large = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
            shared = F.size(F.array_intersect("sa", "sb")).cast("long")
            alike = (100 * small >= percent * large) & (100 * shared >= percent * (small + large - shared))
            return both.filter(alike).select("a", "b").distinct()

        return linkage.Compare(similar, sets.withColumnRenamed("s", "v"), stored_sets, percent, (sets,))

    comps = linkage.linked(members.select(F.col("bands").alias("bucket"), F.col("item").alias("id"), "sketch"), prepare, percent)
    c.discard(folded)
    named = comps.join(numbers, F.col("id") == F.col("item")).select("rep", "component")
    firsts = named.groupBy("component").agg(F.min("rep").alias("first"))
    firsts = c.stored(named.join(firsts, "component").select("rep", "first"), "firsts")
    c.discard(comps, numbers)
    reps = reps.join(firsts, "rep", "left").select("n", "k1", "k2", F.coalesce("first", "rep").alias("component"))
    joined = signed.join(reps, ["n", "k1", "k2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component")), F.col("id")))
    return joined.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that are near copies of one with a smaller id."""
    name = c.fresh_name(docs, "copy_id")
    gone = near_duplicates(docs, id_col, text_col).filter("not kept").select(F.col(id_col).alias(name))
    return docs.join(gone.distinct(), docs[id_col] == F.col(name), "left_anti")


def op2_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(c.table(spark, sf_dir, "documents"), shingle=4)
