from __future__ import annotations

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from drydock.llm import linkage, minhash


def shingles(text, n):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows, n, percent=80):
    sets = {i: shingles(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def corpus(seed=3):
    """Chains and groups around the threshold, copies, short and empty texts."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["É", "e f"]
    rows, texts = [], ["", None, "  \n", "One two", "one TWO", "one", "a b c d", "A B C D", "a b c d e"]
    for _ in range(14):
        base = [rng.choice(vocab) for _ in range(rng.randrange(6, 160))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(0, 9)):
            if rng.random() < 0.3:
                base = list(base)
            else:
                base = base[:]
            for _ in range(rng.randrange(0, max(2, len(base) // 25))):
                base[rng.randrange(len(base))] = rng.choice(vocab)
            texts.append((" " if rng.random() < 0.5 else "\n").join(base))
    rng.shuffle(texts)
    for i, t in enumerate(texts):
        rows.append((i * 7 + 3, t))
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, n string, component int")
    got = minhash.near_duplicates(df.repartition(5), shingle=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4)
    left = minhash.keep_first(df)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [i for i, _, _, kept in brute(rows, 5) if kept]


def test_null_ids_repeats_and_empty_table(spark):
    text = "one two three four five six"
    rows = [(None, text), (4, text), (4, text), (9, text), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, (tuple(r) for r in minhash.near_duplicates(df).collect())))
    assert got == sorted(map(str, [(None, 2, None, True), (4, 2, 4, True), (4, 2, 4, True), (9, 2, 4, False), (9, 0, 9, True)]))
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_coordinates_estimate_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**63, 200).astype(np.uint64)])
    sig = minhash.circulant(np.concatenate([a, b]), np.array([0, 1000, 2000]), 512)
    assert abs((sig[0] == sig[1]).mean() - 800 / 1200) < 0.08


@pytest.mark.parametrize("few", [256, 0])
def test_links_that_the_first_member_lacks(spark, monkeypatch, few):
    """Bucket 1 holds 1 to 150; the only links are 2-3, 4-5, 3-4 and 149-150, as pairs and in blocks."""
    monkeypatch.setattr(linkage, "FEW_PAIRS", few)
    sets = {i: [1000 + i] for i in range(1, 151)} | {2: [1, 2], 3: [2, 3], 4: [3, 4], 5: [4, 5], 149: [7, 8], 150: [8, 9]}
    links = [(2, 3), (4, 5), (3, 4), (149, 150)]
    n = 6 if few else 150
    members = spark.createDataFrame([(1, i) for i in range(1, n + 1)], "bucket long, id long")
    truth = spark.createDataFrame(links, "a long, b long")
    items = spark.createDataFrame(list(sets.items()), "id long, v array<long>")
    compare = linkage.Compare(lambda pairs: pairs.join(truth, ["a", "b"]), items, minhash.stored_sets, 33)
    got = linkage.linked(members, lambda ids: compare)
    assert sorted(map(tuple, got.collect())) == [(2, 2), (3, 2), (4, 2), (5, 2)] + ([] if few else [(149, 149), (150, 149)])


def test_blocks_of_sets(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(linkage, "PRODUCT_WORDS", 16)
    sides = [[np.unique(rng.integers(0, 60, rng.integers(0, 50))) for _ in range(n)] for n in (13, 17)]
    got = linkage.similar_blocks(*sides, 40)
    for i, x in enumerate(sides[0]):
        for j, y in enumerate(sides[1]):
            both = len(set(x) & set(y))
            assert got[i, j] == (both > 0 and 100 * both >= 40 * len(set(x) | set(y)))
    assert linkage.similar_blocks([], sides[1], 80).shape == (0, 17)


@pytest.mark.parametrize("few, blocks", [(256, 1 << 20), (0, 1 << 20), (0, 0)])
def test_blocks_equal_brute_force(spark, monkeypatch, few, blocks):
    monkeypatch.setattr(linkage, "FEW_PAIRS", few)
    monkeypatch.setattr(linkage, "BLOCK_PAIRS", blocks)
    rows = corpus(11)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, minhash.near_duplicates(df, shingle=4, percent=60).collect())) == brute(rows, 4, 60)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 60)]
    got = linkage.components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == [(i, 0) for i in range(41)] + [(100 + k, 100) for k in range(60)]


def test_unlike_members_of_a_large_bucket_meet_by_rare_elements_only(spark, monkeypatch):
    """12,000 items share a bucket and a word; their pairs are 72 million, those that share a rare word two."""
    n = 12_000
    rows = [(i, [-1, *range(1000 + 4 * i, 1004 + 4 * i)]) for i in range(n)]
    rows[77] = (77, rows[5][1][:4] + [3])
    rows[11_000] = (11_000, rows[10_999][1][:4] + [7])
    items = spark.createDataFrame(rows, "id long, v array<long>").withColumn("v", F.array_sort("v"))
    members = items.selectExpr("cast(9 as long) bucket", "id")
    seen = []

    def similar(pairs):
        pairs = pairs.cache()
        seen.append(pairs.count())
        both = pairs.join(items.selectExpr("id a", "v va"), "a").join(items.selectExpr("id b", "v vb"), "b")
        return both.filter("3 * size(array_intersect(va, vb)) >= 2 * size(array_union(va, vb))").select("a", "b")

    compared = []
    real = linkage._links_in_blocks
    monkeypatch.setattr(linkage, "_links_in_blocks", lambda open_, compare: compared.append(open_.count()) or real(open_, compare))
    got = linkage.linked(members, lambda ids: linkage.Compare(similar, items, minhash.stored_sets, 66))
    assert sorted(map(tuple, got.collect())) == [(5, 5), (77, 5), (10_999, 10_999), (11_000, 10_999)]
    assert sum(seen) < 3 * n and sum(compared) < 100


def test_buckets_of_many_tasks_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(linkage, "GATHER", 50)
    rng = np.random.default_rng(4)
    rows = [(int(b), int(i)) for b, i in zip(rng.integers(-(1 << 63), (1 << 63) - 1, 300).repeat(4), rng.integers(0, 400, 1200))]
    rows += [(7, i) for i in range(500)] + [(-1, 3), (-1, 3), (-2, 9)]
    members = spark.createDataFrame(rows, "bucket long, id long").repartition(6)
    monkeypatch.setattr(linkage, "SMALL", 3)
    met = linkage.crowded(members).collect()
    want = {}
    for b, i in rows:
        want.setdefault(b, set()).add(i)
    want_all = dict(want)
    pairs = {(r["lead"], r["id"]) for r in met if r["bucket"] is None}
    small = {(a, b) for ids in want.values() if len(ids) <= 3 for a in ids for b in ids if a < b}
    want = {b: ids for b, ids in want.items() if len(ids) > 3}
    got = {}
    for r in met:
        if r["bucket"] is None:
            continue
        if r["bucket"] not in want:  # several of few members had met in one task
            small -= {(a, b) for a in want_all[r["bucket"]] for b in want_all[r["bucket"]]}
            continue
        got.setdefault(r["bucket"], {}).setdefault(r["id"], set()).add(r["lead"])
    assert {b: set(x) for b, x in got.items()} == want
    assert small <= pairs
    for b, ids in got.items():
        assert all(i == min(want[b]) or any(lead < i for lead in leads) for i, leads in ids.items())


def test_sketches_hide_no_similar_pair():
    """Agreement of sketches follows the similarity, and the bound is as rare as it says."""
    rng = np.random.default_rng(8)
    least = linkage.least_agreement(80)
    sets, before = [], [0]
    for _ in range(400):
        common, own = rng.integers(0, 2**63, 80), rng.integers(0, 2**63, (2, 10))
        for k in range(2):
            sets.append(np.concatenate([common, own[k]]).astype(np.uint64))
            before.append(before[-1] + 90)
    sig = minhash.circulant(np.concatenate(sets), np.array(before), 64)
    sketches = linkage.sketch_bits(sig)
    agree = np.bitwise_count(~(sketches[::2] ^ sketches[1::2]))
    assert (agree >= least).all() and abs(agree.mean() / 64 - 0.9) < 0.01
    others = np.bitwise_count(~(sketches[:-2:2] ^ sketches[2::2]))
    assert (others >= least).mean() < 0.01


def test_string_ids(spark):
    rows = corpus(5)
    df = spark.createDataFrame([(f"{i:05d}", t) for i, t in rows], "doc_id string, text string")
    got = sorted((int(r[0]), r[1], int(r[2]), r[3]) for r in minhash.near_duplicates(df, shingle=4).collect())
    assert got == brute(rows, 4)


def test_names_of_extra_columns(spark):
    rows = corpus(6)
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, _gone int, copy_id int, _copy_id int")
    left = minhash.keep_first(df)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [i for i, _, _, kept in brute(rows, 5) if kept]


def test_members_of_settled_buckets_are_not_labelled(spark, monkeypatch):
    """A group of 100 alike items in 22 buckets is 100 pairs of item and lead, not 2,200 members; a bucket with another group is found."""
    labelled, real = [], linkage._labelled

    def counted(members, comps):
        labelled.append(members.count())
        return real(members, comps)

    monkeypatch.setattr(linkage, "_labelled", counted)
    alike = [(100 + b, i) for b in range(22) for i in range(100)]
    rows = alike + [(7, i) for i in range(40, 100)] + [(7, i) for i in range(500, 530)]
    members = spark.createDataFrame(rows, "bucket long, id long").repartition(3)
    links = spark.createDataFrame([(0, i) for i in range(1, 100)] + [(500, i) for i in range(501, 530)] + [(40, i) for i in range(41, 100)], "a long, b long")
    items = spark.createDataFrame([(i, [1, 2, 3] if i < 100 else [7, 8, 9]) for i in range(530)], "id long, v array<long>")
    compare = linkage.Compare(lambda pairs: pairs.join(links, ["a", "b"], "left_semi"), items, minhash.stored_sets, 80)
    found = {r["id"]: r["component"] for r in linkage.linked(members, lambda ids: compare).collect()}
    assert found == {i: 0 if i < 100 else 500 for i in [*range(100), *range(500, 530)]}
    assert labelled and sum(labelled) < 1000


def test_an_item_is_labelled_once_however_many_leads_it_has(spark, monkeypatch):
    """Each task knows other leads, so items that share many buckets meet many of them."""
    labelled, real = [], linkage._labelled

    def counted(items, comps):
        labelled.append(items.count())
        return real(items, comps)

    monkeypatch.setattr(linkage, "_labelled", counted)
    monkeypatch.setattr(linkage, "SMALL", 3)
    rows = [(100 + b, i) for b in range(22) for i in range(100)] + [(7, i) for i in [*range(60, 100), *range(500, 530)]]
    members = spark.createDataFrame(rows, "bucket long, id long").repartition(12)
    links = spark.createDataFrame([(i - 1, i) for i in range(1, 100)] + [(500, i) for i in range(501, 530)], "a long, b long")
    items = spark.createDataFrame([(i, [1, 2, 3] if i < 100 else [7, 8, 9]) for i in range(530)], "id long, v array<long>")
    compare = linkage.Compare(lambda pairs: pairs.join(links, ["a", "b"], "left_semi"), items, minhash.stored_sets, 80)
    found = {r["id"]: r["component"] for r in linkage.linked(members, lambda ids: compare).collect()}
    assert found == {i: 0 if i < 100 else 500 for i in [*range(100), *range(500, 530)]}
    assert labelled and max(labelled) <= 130


@pytest.mark.parametrize("percent, sizes", [(80, (1, 40)), (80, (200, 300)), (60, (1, 700)), (33, (1, 90)), (80, (3000, 4000))])
def test_bitmaps_miss_no_similar_pair_and_leave_few_others(percent, sizes):
    rng = np.random.default_rng(percent + sizes[1])
    sets = []
    for _ in range(40):
        x = np.unique(rng.integers(-(1 << 62), 1 << 62, rng.integers(*sizes)))
        for _ in range(4):
            sets.append(np.unique(np.concatenate([x[rng.random(len(x)) > 0.07], rng.integers(0, 1 << 62, rng.integers(0, 1 + len(x) // 12))])))
    n, words, maps = linkage.parity_maps(sets)
    assert [len(x) for x in sets] == n.tolist() and (64 * words >= 2 * n).all()
    ends = np.cumsum(words)
    want = linkage.similar_blocks(sets, sets, percent)
    got = np.zeros_like(want)
    for a in np.unique(words):
        for b in np.unique(words):
            of = [np.flatnonzero(words == x) for x in (a, b)]
            rows = [np.stack([maps[ends[k] - w : ends[k]] for k in x]) for x, w in zip(of, (a, b))]
            i, j, apart = linkage.near_maps(*rows, [n[x] for x in of], percent)
            got[of[0][i], of[1][j]] = True
            for x, y, least in zip(of[0][i], of[1][j], apart):
                assert least <= len(np.setxor1d(sets[x], sets[y]))
            if max(a, b) * percent > 200 * min(a, b):
                assert not want[np.ix_(*of)].any()
    assert want.sum() > len(sets) and not (want & ~got).any()
    if sizes[0] > 1:
        assert (got & ~want).mean() < 0.01


def test_unlike_members_of_mixed_buckets_are_not_compared_as_sets(spark, monkeypatch):
    """Buckets of 100 unlike items, two of which are alike, cost two pairs; their blocks hold bitmaps and not the sets."""
    rng = np.random.default_rng(12)
    seen, sets = [], {i: np.unique(rng.integers(0, 1 << 62, 60)) for i in range(400)}
    for b in range(4):
        sets[100 * b + 77] = np.unique(np.append(sets[100 * b + 5][2:], 1 << 61))
    items = spark.createDataFrame([(i, x.tolist()) for i, x in sets.items()], "id long, v array<long>")
    members = spark.createDataFrame([(i // 100, i) for i in sets], "bucket long, id long")

    def similar(pairs):
        pairs = pairs.cache()
        seen.append(pairs.count())
        both = pairs.join(items.selectExpr("id a", "v va"), "a").join(items.selectExpr("id b", "v vb"), "b")
        return both.filter("5 * size(array_intersect(va, vb)) >= 4 * size(array_union(va, vb))").select("a", "b")

    stored, blocks = linkage.stored, []

    def counted(df, label):
        out = stored(df, label)
        if label == "blocks":
            blocks.append(out.selectExpr("explode(of) x").selectExpr("x.*").drop("id", "component", "n"))
            assert blocks[-1].columns == ["bits"] and blocks[-1].agg(F.max(F.octet_length("bits"))).first()[0] == 32
        return out

    monkeypatch.setattr(linkage, "stored", counted)
    got = linkage.linked(members, lambda ids: linkage.Compare(similar, items, minhash.stored_sets, 80))
    assert sorted(map(tuple, got.collect())) == sorted((100 * b + k, 100 * b + 5) for b in range(4) for k in (5, 77))
    assert len(blocks) == 1 and sum(seen) < 450


@pytest.mark.parametrize("few", [0, 1, 100])
def test_many_nearly_similar_pairs_of_a_bucket_do_not_become_rows(spark, monkeypatch, few):
    """200 items of which any two share 87 of 113 elements: their bitmaps leave most of 19,900 pairs, and one pair is alike."""
    monkeypatch.setattr(linkage, "FEW_PAIRS", few)
    rows = [(i, [*range(1000, 1087), *range(10_000 + 13 * i, 10_013 + 13 * i)]) for i in range(200)]
    rows[150] = (150, [*rows[20][1][:-1], 5])
    items = spark.createDataFrame(rows, "id long, v array<long>").withColumn("v", F.array_sort("v"))
    seen = []

    def similar(pairs):
        pairs = pairs.cache()
        seen.append(pairs.count())
        both = pairs.join(items.selectExpr("id a", "v va"), "a").join(items.selectExpr("id b", "v vb"), "b")
        return both.filter("5 * size(array_intersect(va, vb)) >= 4 * size(array_union(va, vb))").select("a", "b")

    compare = linkage.Compare(similar, items, minhash.stored_sets, 80)
    got = linkage.linked(items.selectExpr("cast(3 as long) bucket", "id"), lambda ids: compare)
    assert sorted(map(tuple, got.collect())) == [(20, 20), (150, 20)]
    assert sum(seen) <= 1000 or few > 1
