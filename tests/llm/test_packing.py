from __future__ import annotations

import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest

from drydock.llm import packing
from drydock.llm.tokens import Coder, tokenizer_path


def spread(histogram, runs):
    """Sequences as lists of (offset, length); every piece is placed once."""
    bins, seen = defaultdict(list), defaultdict(list)
    for length, rank, n, first, offset in runs:
        for i in range(n):
            bins[first + i].append((offset, length))
            seen[length].append(rank + i)
    assert {x: sorted(r) for x, r in seen.items()} == {x: list(range(n)) for x, n in histogram.items() if n}
    return bins


def check(histogram, capacity=1024, **kw):
    bins = spread(histogram, packing.plan(histogram, capacity, **kw))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_close_to_the_lower_bound(seed):
    rng = np.random.default_rng(seed)
    sizes = [rng.integers(1, 1025, 20_000), np.minimum(rng.geometric(1 / 300, 20_000), 1024), rng.integers(260, 500, 9_000), rng.integers(1, 60, 5_000), np.full(1000, 400), rng.choice([700, 324, 325], 3000)][seed]
    values, counts = np.unique(sizes, return_counts=True)
    histogram = dict(zip(values.tolist(), counts.tolist(), strict=True))
    n = check(histogram)
    if seed in (0, 1, 3):
        assert n <= 1.015 * sizes.sum() / 1024 + 2
    if seed == 4:
        assert n == 500


def best(sizes, capacity):
    @lru_cache(None)
    def go(left, room):
        if not left:
            return 0
        options = [1 + go(left, capacity)] if room < capacity else []
        for i, x in enumerate(left):
            if x <= room and (i == 0 or left[i - 1] != x):
                options.append(go(left[:i] + left[i + 1 :], room - x))
        return min(options)

    return 1 + go(tuple(sorted(sizes)), capacity) if sizes else 0


def test_plan_against_every_packing():
    rng = random.Random(3)
    over = 0
    for _ in range(60):
        sizes = [rng.randrange(1, 33) for _ in range(rng.randrange(0, 9))]
        histogram = {x: sizes.count(x) for x in sizes}
        got, want = check(histogram, 32, groups=6), best(sizes, 32)
        assert want <= got <= want + 1
        over += got - want
    assert over <= 6


def test_documents(spark):
    rng = random.Random(5)
    texts = [None, "", "a", "word " * 3000, " \n é日 <|endoftext|>"] + ["".join(rng.choice("abc def\n") for _ in range(rng.randrange(0, 3000))) for _ in range(60)]
    rows = [(i * 3, t, "x", 1) for i, t in enumerate(texts)] + [(6, "a", "x", 1), (None, "no id", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string, length int").repartition(4)
    got = packing.pack(df, capacity=64, with_ids=True).collect()
    ids = {(i, t): raw for (i, t, _, _), raw in zip(rows, Coder.of().encode([r[1] for r in rows]), strict=True)}
    want = sorted(((i, k, s, n, zlib.crc32(raw[4 * s : 4 * (s + n)])) for (i, t), raw in [((r[0], r[1]), ids[r[0], r[1]]) for r in rows] for k, (s, n) in enumerate(packing.cut(len(raw) // 4, 64))), key=str)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == want
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in got)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 64
    assert packing.pack(df.limit(0)).count() == 0


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)]
    assert packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(10, 4) == [(0, 2), (2, 4), (6, 4)]


def test_ids_equal_the_tokenizer():
    coder = Coder.of()
    texts = ["a \n b", "  \n\n  a  'sx '''re don't\tx <|endoftext|> \x1c a", "", " ", "\n \n", None, "ünï 12 3a!! ", "x  \n y z", "k" * 500]
    want = [np.array([*coder.tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for t in texts]
    assert coder.encode(texts) == want and coder.encode(texts[::-1]) == want[::-1]


def test_ids_equal_a_freshly_loaded_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    texts = [
        "hello <|endoftext|> world and more words",
        "<|endoftext|>",
        "a<|endoftext|><|endoftext|>  b",
        "one \n<|endoftext|>\n two",
        "ends with it <|endoftext|>",
        "<|endoftext| > is not one, nor <|endof text|>",
        "hello world and more words",
        "ünï <|endoftext|> 12\x1c",
    ]
    want = [np.array([*plain.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes() for t in texts]
    assert sum(50256 in np.frombuffer(x, "<u4") for x in want) == 6
    assert Coder.of().encode(texts) == want and Coder.of().encode(texts[::-1]) == want[::-1]
