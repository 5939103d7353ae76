from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa

from drydock.llm import decontamination as dc


def words(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(rb"[0-9a-z\x80-\xff]+", lowered.encode())


def brute_tiles(a, b, n):
    """Greedy string tiling by trying every pair of positions for the longest match, again and again."""
    used_a, used_b, out = set(), set(), []
    while True:
        best = (n - 1, 0, 0)
        for p in range(len(a)):
            for t in range(len(b)):
                k = 0
                while p + k < len(a) and t + k < len(b) and a[p + k] == b[t + k] and p + k not in used_a and t + k not in used_b:
                    k += 1
                if k > best[0]:
                    best = (k, p, t)
        k, p, t = best
        if k < n:
            return sorted(out)
        out.append((p, t, k))
        used_a |= set(range(p, p + k))
        used_b |= set(range(t, t + k))


def test_tiles_equal_brute_force():
    rng = random.Random(8)
    for _ in range(400):
        vocab = "ab" if rng.random() < 0.3 else "abcdefghijk"
        item = [rng.choice(vocab) for _ in range(rng.randrange(0, 30))]
        text = [rng.choice(vocab) for _ in range(rng.randrange(0, 30))]
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(0, len(item) + 1)
            k = rng.randrange(0, len(text) + 1)
            text = text[:k] + item[at : at + rng.randrange(3, 14)] + text[k:]
        w, first = dc.word_hashes(pa.array([" ".join(item), " ".join(text)]))
        got = dc.tiles(w[: first[1]], w[first[1] :], 3)
        want = brute_tiles(item, text, 3)
        assert sum(x[2] for x in got) == sum(x[2] for x in want) or max(x[2] for x in got) == max(x[2] for x in want)
        assert sorted((x[2] for x in got), reverse=True)[:1] == sorted((x[2] for x in want), reverse=True)[:1]
        if vocab != "ab":
            assert got == want, (item, text)


def test_leaks_equal_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(90)] + ["É1", "日本"]
    items = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(3, 30))) for _ in range(12)] + ["", None]
    docs = [None, "", "w1"]
    for _ in range(60):
        parts = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 40)))]
        if rng.random() < 0.6:
            x = rng.choice(items[:12]).split()
            cut = rng.randrange(len(x))
            parts += rng.choice([[" ".join(x)], [" ".join(x[cut:]).upper(), "zz, " + " ".join(x[:cut])], ["; ".join(x[:cut])]])
        rng.shuffle(parts)
        docs.append("\n".join(parts))
    want = []
    for d, text in enumerate(docs):
        for i, item in enumerate(items):
            a = words(item)
            covered = sum(x[2] for x in brute_tiles(a, words(text), 5)) if a else 0
            if a and covered / len(a) >= 0.5:
                want.append((d, i, len(a), covered))
    assert len(want) > 15
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in enumerate(docs)] + [(None, docs[5], "x", 1)], "doc_id long, text string, item_id string, n int")
    bench = spark.createDataFrame([(i, t, 0) for i, t in enumerate(items)] + [(None, items[0], 0)], "item_id long, text string, doc_id int")
    got = dc.leaks(df.repartition(3), bench)
    assert sorted((r["doc_id"], r["item_id"], r["n_words"], r["covered"]) for r in got.collect()) == want
    left = dc.keep_clean(df, bench)
    assert left.columns == df.columns
    gone = {d for d, _, _, _ in want}
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(d) for d in [*range(len(docs)), None] if d not in gone)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "one two three four five six")], "doc_id long, text string")
    bench = df.withColumnRenamed("doc_id", "item_id")
    assert [r["coverage"] for r in dc.leaks(df, bench).collect()] == [1.0]
    assert dc.leaks(df.limit(0), bench).count() == 0 and dc.leaks(df, bench.limit(0)).count() == 0
    assert dc.keep_clean(df, bench.limit(0)).count() == 1


def test_words_of_every_script():
    texts = ["Don’t “stop”—now", "日本 語x1テ", "สวัสดี", "हिन्दी में", None, "ascii, only 12", "é", "日"]
    want = [["don", "t", "stop", "now"], list("日本語") + ["x1", "テ"], list("สวัสดี"), ["हिन्दी", "में"], [], ["ascii", "only", "12"], ["é"], ["日"]]
    buf, ends = dc.c.text_bytes(pa.array(texts))
    buf = dc.c.lower_ascii(buf)
    starts, stops, first = dc.script_spans(buf, ends)
    words = [bytes(buf[a:b]).decode() for a, b in zip(starts, stops, strict=True)]
    assert [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)] == want


def test_scripts_without_blanks_and_short_items_leak(spark, tmp_path):
    zh = "今天天气很好我们一起去公园散步看花吧"
    items = [(0, zh), (1, "ภาษาไทยไม่มีช่องว่างระหว่างคำ"), (2, "Zyx"), (3, "four words in all"), (4, "he said one two three four five"), (5, "…"), (6, "two words")]
    docs = [
        (0, f"前面还有别的话，{zh}。后面也有。", {0}),
        (1, "กขค ภาษาไทยไม่มีช่องว่างระหว่างคำ งจฉ", {1}),
        (2, "it holds (zyx) once", {2}),
        (3, "here are FOUR words, in all.", {3}),
        (4, "four words but not in all", set()),
        (5, "then he said “one two three four five”", {4}),
        (6, "unrelated zyxw", set()),
        (7, "two words, two words", {6}),
        (8, "two", set()),
    ]
    df = spark.createDataFrame([(d, t) for d, t, _ in docs], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in dc.op3_string_tiling(spark, str(tmp_path)).collect()}
    assert got == {(d, i) for d, _, found in docs for i in found}
    left = dc.keep_clean(df, bench, scripts=True, least_words=1)
    assert sorted(r["doc_id"] for r in left.collect()) == [d for d, _, found in docs if not found]


def test_everyday_phrases_drop_no_document(spark):
    """Short items are listed with every document that holds them, and drop none; extra columns keep their names."""
    item = "which of these seven words comes last"
    texts = ["Yes, the weather is fine today."] * 50 + [f"Before it: {item}, and after it."]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, _gone int, leaked_id int")
    bench = spark.createDataFrame([(0, "Yes"), (1, "the weather"), (2, item)], "item_id long, text string")
    assert dc.leaks(df, bench, scripts=True).count() == 101
    left = dc.keep_clean(df, bench, scripts=True)
    assert left.columns == df.columns and sorted(r["doc_id"] for r in left.collect()) == list(range(50))


def test_repeated_words_take_memory_of_the_words():
    import resource
    import time

    item, text = np.full(200, 7, np.uint64), np.full(500_000, 7, np.uint64)
    before, start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.monotonic()
    assert dc.tiles(item, text, 5) == [(0, 0, 200)]
    mixed = np.tile(np.array([7, 7, 7, 7, 7, 7, 9], np.uint64), 70_000)
    assert [x[2] for x in dc.tiles(item, mixed, 5)] == [6] * 33
    assert time.monotonic() - start < 30
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000
