"""Ranked lexical search by scanning the documents with an automaton of all item terms.

A term is a maximal run of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case. A text is
brought to one form, its terms with single separators between and around them, and so are the terms of the items: the separators
guard them, so an Aho-Corasick automaton finds whole terms only. It gives the number of the term, and
that the items that hold it. There is no index of the documents: the texts are scanned once for the statistics (documents, their
terms, documents per item term), and once more for the scores, of which each task keeps the highest of every item.

What is broadcast is the automaton of a group of items with at most ``GROUP_BYTES`` of distinct terms; a larger set of items
is dealt into several groups, and the texts are scanned for each. Only an item that alone has more makes a larger group.

With ``N`` documents that have a term, ``L`` terms in all, ``n`` terms in a document, ``df`` documents with a term and ``tf``
occurrences, a term weighs ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``, and a document's score is the sum of
``w * (10**9 * tf // (1000 * tf + 8 * m))`` over the item's distinct terms, with ``m = 10 + 90 * n * N // L``, all in integers.

Defined results: a null or empty text, or one of separators only, has no term and is found by no item; an item without terms finds
nothing. Each row counts as a document and each item row as an item, also when ids repeat; equal scores go by id, null
ids last. Extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

BEST = 10
#: Bytes of distinct terms of the items that are searched at once.
GROUP_BYTES = 32 << 20
#: Scores, documents by items, that a task holds at a time.
SCORES = 1 << 21
STATISTICS = "term int, n long"
FOUND = "item int, doc long, score long"
_ALL_DOCUMENTS, _ALL_TERMS = -1, -2
_NO_ID = np.iinfo(np.int64).max

_FORM = np.full(256, 32, np.uint8)
for _low, _high in ((48, 57), (97, 122), (128, 255)):
    _FORM[_low : _high + 1] = np.arange(_low, _high + 1)
_FORM[65:91] = np.arange(97, 123)


def terms_form(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(buffer, ends)``: the texts with blanks for all separators and one more before each text and at the end, and the row limits."""
    buf, ends = c.text_bytes(col)
    out = np.full(len(buf) + len(ends), 32, np.uint8)
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    out[np.arange(len(buf)) + row + 1] = _FORM[buf]
    return out, ends + np.arange(len(ends))


def term_counts(buf: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The number of terms in each row."""
    first = np.flatnonzero((buf[1:] != 32) & (buf[:-1] == 32))
    return np.diff(np.searchsorted(first, ends))


class Items:
    """The terms of a group of items: the automaton, and which items hold a term."""

    def __init__(self, terms_of: list[list[bytes]]):
        self.terms = sorted({t for terms in terms_of for t in terms})
        number = {t: i for i, t in enumerate(self.terms)}
        pairs = sorted({(number[t], i) for i, terms in enumerate(terms_of) for t in terms})
        self.items = np.array([i for _, i in pairs], np.int64)
        self.first = np.searchsorted(np.array([t for t, _ in pairs], np.int64), np.arange(len(self.terms) + 1))
        self.n_items = len(terms_of)
        self.weight: np.ndarray | None = None
        self.documents = self.all_terms = 0
        self._automaton = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automaton": None}

    @property
    def automaton(self):
        """Built once in a worker, which is cheaper than to send it."""
        if self._automaton is None:
            import ahocorasick

            found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for i, term in enumerate(self.terms):
                found.add_word(f" {term.decode('latin-1')} ", i)
            found.make_automaton()
            self._automaton = found
        return self._automaton

    def weigh(self, documents: int, all_terms: int, df: np.ndarray) -> None:
        self.documents, self.all_terms = documents, all_terms
        self.weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64)

    def count(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(terms in each row, row, term, occurrences)``; the last three for each term of the items that a row holds."""
        buf, ends = terms_form(col)
        totals = term_counts(buf, ends)
        found = self.automaton.iter(buf.tobytes().decode("latin-1")) if self.terms else ()
        hits = np.fromiter(chain.from_iterable(found), np.int64).reshape(-1, 2)
        row = np.searchsorted(ends, hits[:, 0] - 1, "right") - 1
        key, tf = np.unique(row * max(len(self.terms), 1) + hits[:, 1], return_counts=True)
        return totals, key // max(len(self.terms), 1), key % max(len(self.terms), 1), tf

    def lengths(self, totals: np.ndarray) -> np.ndarray:
        """``m`` of documents with so many terms."""
        if 90 * self.documents * int(totals.max(initial=0)) < 1 << 63:
            return 10 + 90 * totals * self.documents // max(self.all_terms, 1)
        return np.array([10 + 90 * n * self.documents // self.all_terms for n in totals.tolist()], np.int64)

    def scores(self, totals: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Scores of the documents, in rows, for the items."""
        part = self.weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * self.lengths(totals)[row]))
        n = np.diff(self.first)[term]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[term], n)
        out = np.zeros((len(totals), self.n_items), np.int64)
        np.add.at(out.ravel(), np.repeat(row, n) * self.n_items + self.items[at], np.repeat(part, n))
        return out


class Highest:
    """The highest scores of every item so far, with their documents."""

    def __init__(self, n_items: int, best: int):
        self.best = best
        self.item = self.doc = self.score = np.zeros(0, np.int64)
        self.known = np.zeros(0, bool)
        self.least = np.ones(n_items, np.int64)

    def add(self, docs: np.ndarray, known: np.ndarray, scores: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[row, item[len(self.item) :]]])
        doc, known = np.concatenate([self.doc, docs[row]]), np.concatenate([self.known, known[row]])
        order = np.lexsort((doc, ~known, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        keep = order[rank < self.best]
        last = order[rank == self.best - 1]
        self.least[item[rank == self.best - 1]] = score[last]
        self.item, self.doc, self.score, self.known = item[rank < self.best], doc[keep], score[keep], known[keep]


def _count(items):
    """For each task the documents that hold each term, all documents with a term, and all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pickle.loads(items.value)
        df, documents, all_terms = np.zeros(len(group.terms), np.int64), 0, 0
        for part in c.slices(batches, "t"):
            totals, _, term, _ = group.count(part.column("t"))
            df += np.bincount(term, minlength=len(df))
            documents += int(np.count_nonzero(totals))
            all_terms += int(totals.sum())
        some = np.flatnonzero(df)
        terms = np.concatenate([[_ALL_DOCUMENTS, _ALL_TERMS], some])
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.int32()), pa.array(np.concatenate([[documents, all_terms], df[some]]), pa.int64())], ["term", "n"]
        )

    return run


def _search(items, best: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pickle.loads(items.value)
        highest = Highest(group.n_items, best)
        rows = max(1, SCORES // group.n_items)
        for part in c.slices(batches, "t"):
            for at in range(0, part.num_rows, rows):
                some = part.slice(at, rows)
                ids = some.column("id")
                highest.add(ids.fill_null(_NO_ID).to_numpy(), ids.is_valid().to_numpy(False), group.scores(*group.count(some.column("t"))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(highest.item, pa.int32()), pa.array(highest.doc, pa.int64(), mask=~highest.known), pa.array(highest.score, pa.int64())],
            ["item", "doc", "score"],
        )

    return run


def _item_terms(col: pa.Array) -> list[list[bytes]]:
    buf, ends = terms_form(col)
    return [sorted(set(buf[a:b].tobytes().split())) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in c.slices(batches, "t"):
        terms = [b" ".join(x) for x in _item_terms(part.column("t"))]
        yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(terms, pa.binary()), pa.array([len(x) for x in terms], pa.int64())], ["id", "terms", "bytes"])


def _dealt(items: DataFrame, group_bytes: int) -> tuple[DataFrame, int]:
    """The items with a ``group``, and the number of groups: each has ``group_bytes`` of terms at most, or one item."""
    numbered = items.withColumn("number", F.monotonically_increasing_id())
    total = items.agg(F.sum("bytes")).first()[0] or 0
    groups = -(-total // group_bytes) or 1
    while True:
        dealt = numbered.withColumn("group", F.pmod(F.xxhash64("number"), F.lit(groups)))
        sizes = dealt.groupBy("group").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        if groups == 1 or sizes.filter(f"bytes > {group_bytes} and n > 1").isEmpty():
            return dealt, groups
        groups *= 2


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    best: int = BEST,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``item_col, rank, id_col, score``: the ``best`` documents of each item with a score above 0."""
    spark = docs.sparkSession
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("t"))
    kind = items.schema[item_col].dataType.simpleString()
    asked = items.select(items[item_col].alias("id"), items[item_text_col].cast("string").alias("t"))
    asked = c.stored(asked.mapInArrow(_distinct_terms, f"id {kind}, terms binary, bytes long").filter("bytes > 0"), "items")
    dealt, groups = _dealt(asked, group_bytes)
    best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    out = spark.createDataFrame([], f"{item_col} {kind}, rank int, {id_col} long, score long")
    for g in range(groups):
        rows = dealt.filter(F.col("group") == g).orderBy("number").collect()  # one group, bounded by its bytes
        if not rows:
            continue
        group = Items([bytes(r["terms"]).split() for r in rows])
        sent = spark.sparkContext.broadcast(pickle.dumps(group))
        counts = texts.select("t").mapInArrow(_count(sent), STATISTICS).groupBy("term").agg(F.sum("n").alias("n"))
        n = {r["term"]: r["n"] for r in counts.collect()}  # at most a number for each term of the group
        group.weigh(n.get(_ALL_DOCUMENTS, 0), n.get(_ALL_TERMS, 0), np.array([n.get(i, 0) for i in range(len(group.terms))], np.int64))
        weighed = spark.sparkContext.broadcast(pickle.dumps(group))
        found = texts.mapInArrow(_search(weighed, best), FOUND)
        ranked = found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= best)
        names = spark.createDataFrame([(i, r["id"]) for i, r in enumerate(rows)], f"n int, name {kind}")
        named = ranked.join(F.broadcast(names), F.col("item") == F.col("n"))  # the group's items
        out = out.unionByName(named.select(F.col("name").alias(item_col), "rank", F.col("doc").alias(id_col), "score"))
    return out


def op12_term_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(c.table(spark, sf_dir, "documents"), c.table(spark, sf_dir, "benchmark"))
