from __future__ import annotations

import random

import pyarrow as pa

from drydock.llm import language_id as li

SYLLABLES = {"aa": "ka lo mi pu ta", "bb": "schne tzun ger ich heit", "cc": "né ça où tré eau"}


def corpus(n=240, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3, 60))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus()
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !! \n", "aa"), (1003, "ka", None), (None, "ich heit", "bb"), (1004, "schnetzun " * 30_000, None)]
    df = spark.createDataFrame([(i, t, x, 1, "q") for i, t, x in rows + odd + rows[:3]], "doc_id long, text string, lang string, score int, i string").repartition(3)
    held = li.c.fold_of("doc_id", 3) == 1
    model = li.train(df.filter(~held), "doc_id", "text", "lang")
    got = li.predictions(df, model, "doc_id", "text", held.alias("held_out")).collect()
    assert len(got) == len(rows) + len(odd) + 3
    by_id = {r["doc_id"]: r for r in got}
    tested = [(r, x) for i, _, x in rows if (r := by_id[i])["held_out"]]
    assert len(tested) > 40 and sum(r["lang_pred"] == x for r, x in tested) / len(tested) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    for i in (1000, 1001, 1002):
        assert by_id[i]["lang_pred"] == "und" and by_id[i]["rejected"] and by_id[i]["score"] == 0
    assert by_id[1004]["lang_pred"] == "bb" and by_id[None]["lang_pred"] == "bb"


def test_batches_do_not_matter():
    rows = corpus(60)
    model = li.fit(pa.array([t for _, t, _ in rows]), [x for _, _, x in rows])
    col = pa.array([t for _, t, _ in rows] + [None, "", "x"])
    whole = model.predict(col)
    parts = [model.predict(col.slice(i, 1)) for i in range(len(col))]
    assert whole[0] == [p[0][0] for p in parts]
    assert abs(whole[1] - [p[1][0] for p in parts]).max() < 1e-6


def test_no_training_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = li.train(df, "doc_id", "text", "lang")
    assert [tuple(r) for r in li.predictions(df, model).collect()] == [(1, "und", 0.0, True)]
    assert li.predictions(df.limit(0), model).count() == 0


def test_numerals_are_no_letters():
    assert [li.has_letter(x) for x in ("½ ² ① Ⅷ ٣", "_1", "é", "日", "ª", "ʰ", "")] == [False, False, True, True, True, True, False]


def test_a_language_of_long_texts_only_is_learned(spark):
    rows = [(i, t * (2000 if x == "cc" else 1), x) for i, t, x in corpus(120)]
    assert all(len(t.encode()) > 20_000 for _, t, x in rows if x == "cc")
    df = spark.createDataFrame([*rows, *[(7, rows[7][1], rows[7][2])] * 50], "doc_id long, text string, lang string").repartition(3)
    model = li.train(df, "doc_id", "text", "lang")
    assert model.languages == ["aa", "bb", "cc"]
    assert model.predict(pa.array(["né ça tréeau où éça", "schneheit ich tzun"]))[0] == ["cc", "bb"]
