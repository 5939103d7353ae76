"""The pipeline's stages, one after the other, against a plain version on a small corpus."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import zstandard

import corpus_pipeline
from drydock.llm import decontamination, packing, quality_rules
from drydock.llm.tokens import Coder
from tests.llm import test_decontamination, test_line_dedup, test_minhash, test_quality_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(12)
    syllables = [a + b for a in "bcdfglmnprst" for b in "aeiou"]

    def words(n):
        return ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5))) for _ in range(n)]

    items = [(k, " ".join(words(30))) for k in range(6)]
    shared = " ".join(words(18))
    texts = [None, "", "too short", "the same words " * 200, " ".join(f"{rng.randrange(16**12):012x}" for _ in range(400))]
    for k in range(30):
        lines = [" ".join(words(rng.randrange(10, 40))) for _ in range(rng.randrange(2, 7))]
        if k % 4 == 0:
            lines.insert(1, shared if k % 8 else shared.replace(shared.split()[3], "zz"))
        if k % 9 == 2:
            parts = items[k % 6][1].split()
            lines.append(" ".join(parts[15:] + words(3) + parts[:15]))
        texts.append("\n".join(lines))
        if k % 7 == 3:
            texts += [texts[-1], texts[-1].replace("\n", " ")]
    rng.shuffle(texts)
    return [(i * 5 + 2, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], items


def plain(rows, items):
    """Ids and texts after each stage."""
    pack = zstandard.ZstdCompressor(level=quality_rules.LEVEL, write_checksum=False, write_content_size=False).compress
    docs, stages = {}, []
    for i, t, *_ in rows:
        raw = (t or "").encode()
        if test_quality_rules.brute(t)["base_failed"]:
            continue
        low, high = quality_rules.band_of(len(raw))
        chunks = [raw[a : a + 2048] for a in range(0, len(raw) - 2047, 2048)]
        bad = sum(not 0.25 <= len(pack(x)) / 2048 <= 0.80 for x in chunks)
        if low <= len(pack(raw)) / len(raw) <= high and bad <= 0.25 * len(chunks):
            docs[i] = t
    stages.append(dict(docs))
    gone = defaultdict(set)
    for d, n, _, _, kept in test_line_dedup.brute(sorted(docs.items())):
        if not kept:
            gone[d].add(n)
    docs = {d: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[d]) if gone[d] else t for d, t in docs.items()}
    docs = {d: t for d, t in docs.items() if t.strip(test_line_dedup.BLANK)}
    stages.append(dict(docs))
    kept = {i for i, _, _, kept in test_minhash.brute(sorted(docs.items()), 5) if kept}
    docs = {d: t for d, t in docs.items() if d in kept}
    stages.append(dict(docs))
    words = test_decontamination.words
    for d, t in list(docs.items()):
        for _, item in items:
            covered = sum(x[2] for x in test_decontamination.brute_tiles(words(item), words(t), decontamination.SEED))
            if covered / len(words(item)) >= decontamination.COVER:
                docs.pop(d, None)
    stages.append(dict(docs))
    pieces = []
    for (d, _), raw in zip(docs.items(), Coder.of().encode(list(docs.values())), strict=True):
        pieces += [(d, k, s, n, zlib.crc32(raw[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(packing.cut(len(raw) // 4, 1024))]
    return stages, sorted(pieces)


def test_stages_equal_the_plain_version(spark, tmp_path):
    rows, items = corpus()
    stages, pieces = plain(rows, items)
    assert len(rows) > len(stages[0]) > len(stages[1]) > len(stages[2]) > len(stages[3]) > 10
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for (name, stage), want in zip(corpus_pipeline.STAGES, stages, strict=False):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.schema.simpleString() == spark.createDataFrame([], SCHEMA).schema.simpleString()
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == want, name
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == pieces
    room = defaultdict(int)
    for r in got:
        room[r["sequence_id"]] += r["length"]
    assert max(room.values()) <= 1024


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
