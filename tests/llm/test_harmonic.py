from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from drydock.llm import harmonic
from drydock.llm.tokens import TOKENIZER, tokenizer_path


def padding(totals, capacity):
    return sum(capacity - t for t in totals if t & (t - 1))


def check(rows, texts, capacity, with_ids=False):
    """Every id of every text once, sequences without gaps; the padding and the number of sequences."""
    plain = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    want = defaultdict(list)
    for key, text in texts:
        want[key].append([*plain.encode(text or "", add_special_tokens=False).ids, harmonic.END_ID])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert by_doc.keys() == want.keys()
    for key, pieces in by_doc.items():
        got = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces)
        expected = []
        for ids in want[key]:
            mine = sorted({(r["start"], r["length"]) for r in pieces if r["doc_tokens"] == len(ids)})
            assert [a for a, _ in mine] == np.cumsum([0, *[n for _, n in mine]])[:-1].tolist()
            assert sum(n for _, n in mine) == len(ids)
            raw = np.array(ids, "<u4").tobytes()
            expected += [(a, n, zlib.crc32(raw[4 * a : 4 * (a + n)]), len(ids)) for a, n in mine]
        assert got == sorted(expected)
    if with_ids:
        assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    totals = []
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        totals.append(at)
    return padding(totals, capacity), len(totals)


@pytest.mark.parametrize("capacity, slack", [(2048, 8), (64, 0), (100, 1), (7, 2), (1, 0)])
def test_cuts_are_class_lengths_and_sum_up(capacity, slack):
    allowed = set(harmonic.class_lengths(capacity, slack).tolist())
    for n, cuts in enumerate(harmonic.cuts_by_rest(capacity, slack)):
        assert sum(cuts) == n and set(cuts) <= allowed and cuts == sorted(cuts, reverse=True)
    assert all(capacity - capacity // x * x <= slack for x in allowed)


def test_fill_completes_every_class():
    lengths = np.random.default_rng(1).choice(harmonic.class_lengths(2048, 8), 20_000)
    done, sequence, offset, n = harmonic.fill(lengths, 2048)
    totals = np.bincount(sequence, lengths[done], n)
    assert (totals >= 2040).all()
    for x in np.unique(lengths):
        left = np.count_nonzero(lengths == x) - np.count_nonzero(lengths[done] == x)
        assert left < 2048 // x
    order = np.lexsort((offset, sequence))
    ends = np.cumsum(lengths[done][order])
    starts = ends - lengths[done][order]
    first = np.searchsorted(sequence[order], np.arange(n))
    assert (offset[order] == starts - starts[first][sequence[order]]).all()


def test_best_fit_fills_what_fits():
    lengths = np.array([5, 5, 3, 3, 2, 2, 10])
    sequence, offset = harmonic.best_fit(lengths, 10)
    assert len(set(sequence.tolist())) == 3
    assert np.bincount(sequence, lengths).tolist() == [10, 10, 10]


def test_repeated_ids_and_clashing_columns(spark):
    rng = np.random.default_rng(2)
    texts = [(i, " ".join(rng.choice(["the", "cat", "sat", "mat."], rng.integers(0, 900)))) for i in range(150)]
    texts += [(500, "a b"), (500, "a b"), (501, "word " * 30_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "1 as id", "2 as part", "3 as length", "4 as t", "5 as sequence_id").repartition(10)
    rows = harmonic.pack(docs, fan=3).collect()
    pad, _ = check(rows, texts, 2048)
    assert pad <= 0.01 * sum(r["length"] for r in rows) + 2048
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)


def test_pieces_equal_the_plain_tokenizer(spark):
    rng = np.random.default_rng(3)
    texts = [(i, " ".join(rng.choice(["the", "cat", "sat", "über", "<|endoftext|>"], rng.integers(0, 400)))) for i in range(80)]
    texts += [(100, None), (101, ""), (None, "no id"), (102, "x" * 9000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    for capacity, fan in ((2048, 8), (256, 2)):
        rows = harmonic.pack(docs, capacity=capacity, with_ids=True, fan=fan).collect()
        pad, n = check(rows, texts, capacity, with_ids=True)
        total = sum(r["length"] for r in rows)
        assert pad <= 0.01 * total + capacity
        assert n <= total / capacity * 1.01 + 2


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert harmonic.pack(docs).collect() == []
