from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from drydock.llm import term_scan

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {ord(a): ord(a) + 32 for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, best=10):
    counts = [(key, Counter(terms(text))) for key, text in docs]
    n_docs, n_terms = sum(bool(x) for _, x in counts), sum(sum(x.values()) for _, x in counts)
    df = Counter(t for _, x in counts for t in x)
    out = []
    for item, text in items:
        found = []
        for key, x in counts:
            n = sum(x.values())
            score = 0
            for t in set(terms(text)) & x.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * x[t] // (1000 * x[t] + 8 * (10 + 90 * n * n_docs // n_terms)))
            if score > 0:
                found.append((-score, key is None, key))
        found.sort(key=lambda r: (*r[:2], r[2] or 0))
        out += [(item, i + 1, key, -score) for i, (score, _, key) in enumerate(found[:best])]
    return sorted(out, key=str)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as id", "'x' as t", "2 as score", "3 as rank").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as n", "'y' as terms", "2 as number", "3 as `group`")
    return sorted((tuple(r) for r in term_scan.search(d, b, **kw).collect()), key=str)


DOCS = [
    (1, "The cat sat on the mat."),
    (2, "the CAT, the cat; the-cat!"),
    (3, "Straße über-Ärger ÄRGER ärger"),
    (4, None),
    (5, " \t. --- \x00"),
    (6, "concatenate scatter cats"),
    (7, "the cat sat on the mat."),
    (None, "the cat sat on the mat."),
    (8, "cat\x7fcat cat\x00mat 1cat cat_1 日本語 日本"),
    (9, "cat " * 5000),
    (7, "the cat sat on the mat."),
    (10, ""),
]
ITEMS = [(1, "cat mat"), (2, "The THE the"), (3, "ärger Ärger"), (4, None), (5, "..."), (6, "absent"), (7, "日本"), (1, "sat"), (None, "scatter cat"), (8, "1 1cat")]


@pytest.mark.parametrize("group_bytes", [1 << 20, 8])
def test_equals_brute_force(spark, group_bytes):
    assert run(spark, DOCS, ITEMS, best=4, group_bytes=group_bytes) == brute(DOCS, ITEMS, 4)


def test_many_documents_keep_the_best(spark, monkeypatch):
    words = ["a", "b", "c", "dd", "ee", "é", "f1"]
    docs = [(i, " ".join(words[(i * k) % 7] for k in range(1, i % 23))) for i in range(600)]
    items = [(k, " ".join(words[k : k + 3])) for k in range(7)]
    monkeypatch.setattr(term_scan, "SCORES", 50)
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], ITEMS) == []
    assert run(spark, DOCS, []) == []
    assert run(spark, [(1, None), (2, "..")], ITEMS) == []


def test_lengths_beyond_64_bits():
    group = term_scan.Items([[b"a"]])
    group.weigh(10**12, 10**15, [5])
    import numpy as np

    assert group.lengths(np.array([10**9, 3])).tolist() == [10 + 90 * 10**9 * 10**12 // 10**15, 10 + 90 * 3 * 10**12 // 10**15]
