from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from drydock.llm import quality_classifier as qc


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(5, 80))]
        good = rng.random() < 0.6
        text = " ".join(words) if good else rng.choice([" ".join(w.upper() + "!!" for w in words), " ".join(w + "###" for w in words), " ".join(words[:2] * len(words))])
        rows.append((i, text, int(good)))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus()
    odd = [(900, None), (901, ""), (902, " \n "), (903, "x" * 200_000), (None, "abc def")]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t, _ in rows] + [(*o, "s", 1) for o in odd] + [(0, rows[0][1], "s", 1)], "doc_id long, text string, features string, score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5000, 1), (3, None)], "doc_id long, quality int")
    held = qc.c.fold_of("doc_id", 5) == 0
    x = qc.featured(df.repartition(3), "doc_id", "text", held.alias("held_out"))
    model = qc.train(x.filter("not held_out").join(labels, "doc_id"))
    got = qc.scored(x, model).collect()
    assert len(got) == len(rows) + len(odd) + 1
    by_id = {r["doc_id"]: r for r in got}
    tested = [(by_id[i], y) for i, _, y in rows if by_id[i]["held_out"]]
    assert len(tested) > 40 and sum(r["predicted"] == y for r, y in tested) / len(tested) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert by_id[900]["score"] == by_id[901]["score"]


def test_pairs_learn_what_no_single_feature_shows():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(qc.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 7] > 0.5)).astype(float)
    model = qc.fit(x, y)
    assert (7, 2) in model.pairs
    assert ((model.score(x) > 0.5) == y).mean() > 0.85


def test_features_do_not_depend_on_batches():
    col = pa.array([t for _, t, _ in corpus(40)] + [None, "", "É x", "12 34\n12 34"])
    whole = qc.features(col)
    assert np.allclose(whole, np.concatenate([qc.features(col.slice(i, 1)) for i in range(len(col))]))
    assert not whole[-3].any() and not whole[-4].any()


def test_no_labels_one_class_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    x = qc.featured(df)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in qc.scored(x, qc.train(x.join(none, "doc_id"))).collect()} == {0.5}
    ones = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert all(abs(r["score"] - 2 / 3) < 1e-9 for r in qc.scored(x, qc.train(x.join(ones, "doc_id"))).collect())
    assert qc.scored(x.limit(0), qc.train(x.join(ones, "doc_id"))).count() == 0
