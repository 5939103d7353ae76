from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from drydock.llm import merkle


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def levels_of(nodes, fan=8):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + fan])) for i in range(0, len(out[-1]), fan)])
    return out


def path(levels, index, fan=8):
    out = []
    for nodes in levels[:-1]:
        first = index // fan * fan
        out.append(("".join(nodes[first:index]), "".join(nodes[index + 1 : first + fan])))
        index //= fan
    return out


def lower(text):
    return text and "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text)


def brute(rows, fan=8):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees.append(levels_of([x[2] for x in groups[name]], fan))
    top = levels_of([t[-1][0] for t in trees], fan)
    out = []
    for g, (name, tree) in enumerate(zip(names, trees, strict=True)):
        for i, (_, _, own, r) in enumerate(groups[name]):
            steps = path(tree, i, fan) + path(top, g, fan)
            key = "" if r[0] is None else str(r[0])
            node = leaf((*r[:4], lower(r[4]))) if zlib.crc32(key.encode()) % 3 == 0 else own
            for a, b in steps:
                node = h(a + node + b)
            out.append((r[0], own, tree[-1][0], top[-1][0], h("".join(a + b for a, b in steps)), node, node == top[-1][0]))
    return sorted(out, key=str)


def run(spark, rows, fan=8, levels=3):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.selectExpr("*", "1 as id", "2 as node", "3 as tree", "4 as part", "5 as leaf", "6 as root").repartition(5)
    changed = {"text": F.translate(docs["text"], merkle.UPPER, merkle.LOWER)}
    out = merkle.manifest(docs, changed=changed, where=merkle.c.fold_of("doc_id", 3) == 0, fan=fan, levels=levels)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("fan, levels, n", [(8, 3, 1), (8, 3, 8), (8, 3, 9), (8, 3, 65), (8, 3, 513), (2, 2, 37), (3, 1, 28), (2, 5, 33)])
def test_places_follow_from_level_and_index(fan, levels, n):
    nodes = [h(str(i)) for i in range(n)]
    levels = min(levels, len(levels_of(nodes, fan)) - 1)
    log = merkle.append_log(nodes, levels, fan)
    assert len(log) == merkle.size(n, levels, fan)
    full = levels_of(nodes, fan)
    for level in range(levels + 1):
        for i, node in enumerate(full[level]):
            assert log[merkle.place(level, i, n, levels, fan)] == node
    text = "".join(log)
    for i in range(n):
        assert merkle.siblings(text, n, i, levels, fan) == path(full[: levels + 1], i, fan)


def some(n, seed=0):
    rng = random.Random(seed)
    texts = ["Ab cD", "", None, "ÄÖ x", "plain", "long " * 3000]
    ids = [*range(n), *rng.sample(range(n), n // 20)]
    return [(i, rng.choice(["s", None]), rng.choice(["de", "fr", "fr", "fr", None, "", "Zz", "é"]), rng.choice([None, 5]), rng.choice(texts)) for i in ids]


@pytest.mark.parametrize("fan, levels", [(8, 3), (8, 1), (2, 2)])
def test_equals_brute_force(spark, fan, levels):
    rows = [*some(300), (None, None, None, None, None), (None, None, None, None, None), (7, None, "only", 1, "One LEAF")]
    got = run(spark, rows, fan, levels)
    assert got == brute(rows, fan)
    assert {r[-1] for r in got} == {True, False}


def test_several_rounds_in_one_hot_group(spark):
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(1200)]
    assert run(spark, rows) == brute(rows)


def test_many_groups(spark):
    rows = [(i, "s", f"lang{i % 90}", None, "x Y") for i in range(200)]
    assert run(spark, rows) == brute(rows)


def test_single_and_no_row(spark):
    assert run(spark, []) == []
    rows = [(3, "a", None, 2, "Aa")]
    got = run(spark, rows)
    assert got == brute(rows) and got[0][4] == h("") and got[0][1] == got[0][3]
