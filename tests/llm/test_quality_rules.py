from __future__ import annotations

import base64
import random
import re

import pytest

from drydock.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n")]
    seen, dup = set(), 0
    for line in lines:
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    wins = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(i, i + 8)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(ch in "#*$%&|<>" for ch in text),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 20 or 100 * len(covered) > 30 * len(words),
    }


def cases():
    rng = random.Random(4)
    vocab = ["a", "the", "né", "x y", "日本", "***", "<b>", "End."]
    texts = [None, "", " ", "\n\n", "a", "a\n\na\n \n ", "né " * 40, "\x0b\x0c a\x1cb"]
    for _ in range(60):
        words = [rng.choice(vocab) for _ in range(rng.randrange(0, 90))]
        texts.append("".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in words))
    unique = " ".join(f"w{rng.randrange(10**9)}" for _ in range(300))
    return [*texts, unique, unique + " " + unique[:900], "z" * 300_000]


def test_counts_equal_brute_force(spark):
    texts = cases()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r.asDict() for r in q.verdicts(df).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = brute(text)
        assert {k: got[i][k] for k in want} == want, (i, text)
        assert not (got[i]["base_failed"] and got[i]["kept"])


def test_bands(spark):
    rng = random.Random(1)
    syllables = [a + b for a in "bcdfglmnprst" for b in "aeiou"]
    prose = " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(800))
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(3)) for _ in range(800))
    table = "\n".join(f"line {i:05d} of the same old table of values" for i in range(400))
    half = prose[:3000] + " " + " ".join(f"aa{i % 97}" for i in range(1600))
    rows = [(0, prose, 1), (1, noise, 2), (2, table, 3), (3, half, 4), (0, prose, 1), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    got = sorted((r["doc_id"], r["kept"]) for r in q.verdicts(df).collect() if r["doc_id"] is not None)
    assert got == [(0, True), (0, True), (1, False), (2, False), (3, False)]
    left = q.keep_good(df)
    assert left.columns == df.columns
    assert sorted(map(tuple, left.collect())) == [(0, prose, 1), (0, prose, 1)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert q.verdicts(df).count() == 0 and q.keep_good(df).count() == 0


@pytest.mark.parametrize("size", [0, 127, 128, 5000, 10**9])
def test_every_length_has_a_band(size):
    low, high = q.band_of(size)
    assert low < high


def test_chunks_cover_every_byte():
    for size in (0, 1, 2047, 2048, 2049, 4095, 4096, 10_000):
        covered = {b for k in q.chunk_starts(size) for b in range(k, min(k + q.CHUNK, size))}
        assert covered == set(range(size)) and len(q.chunk_starts(size)) == -(-size // q.CHUNK)


def test_encoded_parts_and_tails_are_rejected(spark):
    rng = random.Random(6)
    syllables = [a + b for a in "bcdfglmnprst" for b in "aeiou"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(400)]

    def prose(size):
        return " ".join(rng.choice(words) for _ in range(size))[:size]

    def coded(size):
        raw = base64.b64encode(rng.randbytes(size)).decode()
        return "\n".join(raw[k : k + 76] for k in range(0, len(raw), 76))[:size]

    def mixed(share):
        return prose(int(20_000 * (1 - share))) + "\n" + coded(int(20_000 * share))

    clean = [prose(n) for n in (300, 700, 1500, 2047, 2049, 3998, 20_000)]
    dirty = [prose(2048) + coded(1950), prose(300) + coded(1700), prose(200) + coded(1800), coded(1800), mixed(0.4), mixed(0.5), mixed(0.7)]
    df = spark.createDataFrame(list(enumerate(clean + dirty)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in q.verdicts(df).collect()}
    assert [got[k]["kept"] for k in range(len(clean))] == [True] * len(clean)
    assert [got[k]["kept"] for k in range(len(clean), len(got))] == [False] * len(dirty)
    assert not any(got[k]["base_failed"] for k in range(len(got) - 3, len(got)))
    assert got[len(clean)]["n_chunks"] == 2 and got[len(clean)]["n_bad_chunks"] == 1
