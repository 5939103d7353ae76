from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa

from drydock.llm import line_dedup as ld

BLANK = " \t\n\x0b\x0c\r"


def brute(rows):
    places = sorted(
        (i, n, line.strip(BLANK)) for i, t in rows if i is not None for n, line in enumerate((t or "").split("\n")) if line.strip(BLANK)
    )
    root = list(range(len(places)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [ld.char_set(line) for _, _, line in places]
    for x in range(len(places)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and 100 * both >= 80 * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return sorted((d, n, *places[find(k)][:2], find(k) == k) for k, (d, n, _) in enumerate(places))


def corpus(seed=5):
    rng = random.Random(seed)
    pool = ["", " ", "short", "x", "néé ü", " "]
    for _ in range(25):
        words = [rng.choice("abcdefgh") + "".join(rng.choice("aeiouéß日") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(2, 40))]
        pool.append(" ".join(words))
        for _ in range(rng.randrange(0, 4)):
            changed = list(words)
            changed[rng.randrange(len(words))] = "zz"
            pool.append("  " + " ".join(changed) + rng.choice(["", "\r", "\t "]))
    return [(k * 3 + 1, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 9)))) for k in range(40)] + [(2, None), (5, "")]


def test_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "k", 0) for i, t in rows], "doc_id long, text string, line string, kept int").repartition(4)
    want = brute(rows)
    assert sorted(map(tuple, ld.line_classes(df).collect())) == want
    gone = {(d, n) for d, n, _, _, kept in want if not kept}
    texts = {}
    for i, t in rows:
        lines = [(n, x) for n, x in enumerate(t.split("\n")) if (i, n) not in gone] if t is not None else None
        kept = None if lines is None else "\n".join(x for _, x in lines)
        if any(d == i for d, _ in gone) and not kept.strip(BLANK):
            continue
        texts[i] = kept
    left = ld.remove_repeats(df)
    assert left.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in left.collect()} == texts


def test_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ld.linkage, "FEW_PAIRS", 0)
    rows = corpus(8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, ld.line_classes(df).collect())) == brute(rows)


def test_names_of_extra_columns(spark):
    names = ["_gone", "_id", "id_of_lines", "gone_lines", "rest_of_text", "_gone_lines"]
    df = spark.createDataFrame([(1, "a line of words", *range(6)), (2, "a line of words\nanother one", *range(6))], f"doc_id long, text string, {' int, '.join(names)} int")
    left = ld.remove_repeats(df)
    assert left.columns == df.columns
    assert sorted(map(tuple, left.collect())) == [(1, "a line of words", *range(6)), (2, "another one", *range(6))]


def test_a_text_of_very_many_repeated_lines(spark):
    line = "the same line again and again"
    df = spark.createDataFrame([(1, "\n".join([line] * 80_000 + ["and quite another one at the end"]))], "doc_id long, text string")
    start = time.monotonic()
    assert ld.remove_repeats(df).collect()[0]["text"] == f"{line}\nand quite another one at the end"
    assert time.monotonic() - start < 60


def test_null_ids_repeats_and_empty_table(spark):
    line = "a line that is long enough to have shingles"
    rows = [(None, line), (3, line), (3, line), (7, f"{line}\nand one of its own, quite different")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, ld.line_classes(df).collect()))
    assert got == [(3, 0, 3, 0, True), (3, 0, 3, 0, True), (7, 0, 3, 0, False), (7, 1, 7, 1, True)]
    left = sorted(map(str, map(tuple, ld.remove_repeats(df).collect())))
    assert left == sorted(map(str, [(None, line), (3, line), (3, line), (7, "and one of its own, quite different")]))
    assert ld.line_classes(df.limit(0)).count() == 0 and ld.remove_repeats(df.limit(0)).count() == 0


def test_hashes_do_not_depend_on_the_rest_of_the_buffer():
    lines = ["plain words only", "short", "né日 ünd so weiter", "plain words only"]
    seen = {}
    for col in ([lines[0]], lines, ["日本"] + lines, lines[::-1]):
        buf, ends = ld.c.text_bytes(pa.array(col))
        starts, stops, row, _ = ld.line_spans(buf, ends)
        v, before = ld.shingle_hashes(buf, starts, stops, 9)
        for k, r in enumerate(row):
            got = v[before[k] : before[k + 1]].tolist()
            assert len(got) == max(1, len(col[r]) - 8)
            assert seen.setdefault(col[r], got) == got


def test_planted_edits_in_ordinary_lines(spark):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    lines, want = [], []
    for length in range(30, 125, 3):
        for new, least in (("#", 49), ("ABCDEF", 94)):
            line = "".join(rng.choice(letters) for _ in range(length))
            at = rng.randrange(8, length - 16)
            want += [len(lines), len(lines) if length >= least else len(lines) + 1]
            lines += [line, line[:at] + new + line[at + len(new) :]]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["doc_id"]: r["first_doc"] for r in ld.line_classes(df).collect()}
    assert [got[k] for k in range(len(lines))] == want


def test_only_texts_that_share_a_bucket_are_stored(spark, monkeypatch):
    rng = random.Random(9)
    lines = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(90)).strip() + "." for _ in range(300)]
    rows = [(k, line) for k, line in enumerate(lines)] + [(1000, lines[7] + "!"), (1001, lines[8] + "?")]
    stored, sizes = ld.c.stored, {}

    def counted(df, label):
        out = stored(df, label)
        sizes.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(ld.c, "stored", counted)
    monkeypatch.setattr(ld.linkage, "BITMAP_WORDS", 1)  # a bitmap that is full, as it is with very many ids
    found = ld.line_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted((r["doc_id"], r["first_doc"]) for r in found.filter("not kept").collect()) == [(1000, 7), (1001, 8)]
    assert sizes["candidates"] == [4] and sizes["reps"] == [4] and sizes["firsts"] == [4]


def test_signatures_do_not_depend_on_the_step(monkeypatch):
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 40, 200)
    before = np.concatenate([[0], np.cumsum(sizes)])
    values = rng.integers(0, 1 << 64, before[-1], np.uint64)
    want = ld.signature(values, before, 12)
    assert np.array_equal(want[5], ld.signature(values[before[5] : before[6]], np.array([0, sizes[5]]), 12)[0])
    for step in (1, 30, 1000):
        monkeypatch.setattr(ld, "NEAR", step)
        assert np.array_equal(want, ld.signature(values, before, 12))


def test_spans_and_hashes_of_lines():
    """As by hand, with runs of blanks longer than what goes one by one; equal lines have equal hashes wherever they begin, others have others."""
    rng = random.Random(6)
    kinds = ["a", "bc", "é", "日", " ", "\n", "\n", "\t", "\r", "\x0b\x0c", " " * 20, "x" * 9, "\x00"]
    seen = {}
    for _ in range(300):
        rows = ["".join(rng.choice(kinds) for _ in range(rng.randrange(0, 14))) for _ in range(rng.randrange(0, 6))]
        buf, ends = ld.c.text_bytes(pa.array(rows, pa.string()))
        starts, stops, row, number = ld.line_spans(buf, ends)
        want = [(r, n, line.strip(BLANK).encode()) for r, t in enumerate(rows) for n, line in enumerate(t.split("\n")) if line.strip(BLANK)]
        assert [(r, n, buf[a:b].tobytes()) for a, b, r, n in zip(starts, stops, row, number)] == want
        for (_, _, line), *hashes in zip(want, *ld.line_hashes(buf, starts, stops)):
            assert seen.setdefault(line, hashes) == hashes
    assert all(len({h[k] for h in seen.values()}) == len(seen) > 200 for k in range(2))


def test_only_known_lines_leave_the_scan_for_texts(spark):
    rng = random.Random(7)
    lines = ["".join(rng.choice("abcdefgh ") for _ in range(40)) + "." for _ in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(["\n".join(lines[k : k + 50]) for k in range(0, 500, 50)])], ["t"])
    _, _, _, _, _, k1, k2 = ld._lines(batch)
    ids = (k1 ^ k2).view(np.int64)[[3, 77, 400]].tolist()
    known = ld.linkage.bitmap(spark.createDataFrame([(x,) for x in ids], "id long"), "id")
    (out,) = ld._line_texts(known)(iter([batch]))
    assert {lines[3], lines[77], lines[400]} <= set(out.column("l").to_pylist()) and out.num_rows < 100
    assert set(ids) <= set(out.column("id").to_pylist())


def test_sets_are_made_of_pairs_that_may_be_similar_only(monkeypatch):
    rng = random.Random(8)
    lines = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randrange(3, 400))) + "." for _ in range(60)]
    lines += [x[:-4] + "é" + x[-4:] for x in lines] + ["ha " * k for k in (1, 2, 50, 70)]
    pairs = [(a, b) for a in range(len(lines)) for b in range(a)]
    made, real = [], ld._distinct_sorted
    monkeypatch.setattr(ld, "_distinct_sorted", lambda values: made.append(1) or real(values))
    columns = [pa.array(x) for x in (*zip(*pairs), *([lines[p[k]] for p in pairs] for k in range(2)))]
    batch = pa.RecordBatch.from_arrays(columns, ["a", "b", "ta", "tb"])
    got = sorted((x, y) for out in ld._similar(5, 80)(iter([batch])) for x, y in zip(out.column("a").to_pylist(), out.column("b").to_pylist()))
    sets = [ld.char_set(x) for x in lines]
    assert got == sorted((a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    assert len(got) > 30 and sum(made) < len(pairs) / 10
