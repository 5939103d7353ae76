"""Words, hashes and windows of whole batches against plain loops."""

from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa

import corpus_pipeline
from drydock.llm import common as c
from drydock.llm import tokens

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def texts():
    rng = random.Random(2)
    out = [None, "", " ", "a", " a", "a ", "\n\x0b", "é", "\x1c \x85 "]
    return out + ["".join(rng.choice("ab é日 \n\t") for _ in range(rng.randrange(0, 30))) for _ in range(200)]


def test_spans_and_hashes():
    rows = texts()
    buf, ends = c.text_bytes(pa.array(rows))
    starts, stops, first = c.spans(buf, ends)
    h = c.span_hashes(buf, starts, stops)
    seen = {}
    for k, text in enumerate(rows):
        words = WORD.findall((text or "").encode())
        assert [bytes(buf[a:b]) for a, b in zip(starts[first[k] : first[k + 1]], stops[first[k] : first[k + 1]])] == words
        for w, x in zip(words, h[first[k] : first[k + 1]].tolist(), strict=True):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_windows_and_distinct():
    h = np.array([1, 2, 3, 1, 2, 3, 9, 4, 4], np.uint64)
    first = np.array([0, 6, 6, 7, 9])
    v, before = c.windows(h, first, 3)
    assert np.diff(before).tolist() == [4, 0, 1, 1]
    assert v[0] == v[3] and len(set(v.tolist())) == 5
    d, limits = c.distinct_in_rows(v, before)
    assert np.diff(limits).tolist() == [3, 0, 1, 1]
    assert all((np.diff(d[a:b].astype(float)) > 0).all() for a, b in zip(limits[:-1], limits[1:]))


def test_slices_keep_every_row():
    rows = texts() + ["x" * 5000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows)], ["i", "t"])
    parts = list(c.slices(iter([batch, batch.slice(3, 0), batch.slice(5)]), "t", 100))
    assert [x for p in parts for x in p.column("i").to_pylist()] == [*range(len(rows)), *range(5, len(rows))]
    assert all(p.num_rows == 1 or len(c.text_bytes(p.column("t"))[0]) <= 100 for p in parts)


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 as v")
    one = c.hashed_sample(df, "id", 300).collect()
    two = c.hashed_sample(df.repartition(9, "v"), "id", 300).collect()
    assert len(one) == 300 and sorted(map(tuple, one)) == sorted(map(tuple, two))
    assert c.hashed_sample(df.limit(0), "id", 10).count() == 0 and c.hashed_sample(df, "id", 10**6).count() == 5000


def test_hashes_of_texts_of_repeated_blocks_differ():
    """The Thue-Morse word and its complement agree in every polynomial modulo 2**64 from 1,024 bytes on."""
    word = "a"
    while len(word) < 4096:
        word += word.translate({97: 98, 98: 97})
    rows = [word, word.translate({97: 98, 98: 97})]
    buf, ends = c.text_bytes(pa.array(rows))
    assert len(set(c.span_hashes(buf, ends[:-1], ends[1:]).tolist())) == 2


def test_hashes_of_long_spans():
    """Spans beyond a piece, at any place; one changed byte changes the hash."""
    rng = np.random.default_rng(1)
    for n in (c.PIECE - 1, c.PIECE, c.PIECE + 1, 3 * c.PIECE, 70_001, c.PIECE * c.PIECE // 4 + 3):
        text = rng.integers(32, 127, n).astype(np.uint8)
        buf = np.concatenate([text, np.zeros(3, np.uint8), text, text[:9]])
        a, b, short = c.span_hashes(buf, np.array([0, n + 3, 2 * n + 3]), np.array([n, 2 * n + 3, 2 * n + 12])).tolist()
        assert a == b == c.span_hashes(text, np.array([0]), np.array([n]))[0]
        assert short == c.span_hashes(text, np.array([0]), np.array([9]))[0]
        text[n // 2] ^= 1
        assert c.span_hashes(text, np.array([0]), np.array([n]))[0] != a


def test_hashes_in_a_long_buffer():
    rng = np.random.default_rng(0)
    buf = rng.integers(32, 127, (1 << 23) + 5000).astype(np.uint8)
    buf[-200:] = buf[:200]
    a, b = c.span_hashes(buf, np.array([0, len(buf) - 200]), np.array([200, len(buf)]))
    assert a == b == c.span_hashes(buf[:200], np.array([0]), np.array([200]))[0]


def test_remembered_runs_take_little_memory():
    coder = tokens.Coder(tokens.TOKENIZER, tokens.END_ID)
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**9)}" for _ in range(20_000)]
    tracemalloc.start()
    coder.encode([" ".join(words[k : k + 500]) for k in range(0, len(words), 500)])
    size = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    c.at_task_end.remove(coder._task_end)
    held = len(coder.store)
    coder.encode(["a b"], held - 1)
    assert len(coder.store) < held  # the table started anew
    coder.encode([" ".join(words)])
    assert len(coder.store) > 15_000
    assert size / len(coder.store) * corpus_pipeline.REMEMBERED < 100 << 20  # beside the memory of the worker and of its executor


def test_new_runs_are_coded_in_short_texts():
    """The tokenizer's time for a character grows with the length of a text, so new runs go to it some at a time."""
    coder = tokens.Coder(tokens.TOKENIZER, tokens.END_ID)
    c.at_task_end.remove(coder._task_end)
    tokenizer, lengths = coder.tokenizer, []

    class Watched:
        def encode_batch_fast(self, batch, **options):
            lengths.extend(len(x.split(" ")) for x in batch)
            return tokenizer.encode_batch_fast(batch, **options)

    rng = random.Random(8)
    rows = [" ".join("".join(rng.choice("abcdé日.,'\n") for _ in range(rng.randrange(1, 9))) for _ in range(n)) for n in (1, 63, 64, 65, 3000, 9000)]
    want = [np.array([*x.ids, tokens.END_ID], "<u4").tobytes() for x in tokenizer.encode_batch_fast(rows, add_special_tokens=False)]
    coder.tokenizer = Watched()
    assert coder.encode(rows) == want
    assert max(lengths) < 2 * tokens.JOINED and sum(lengths) > 9000  # a run may hold spaces itself
