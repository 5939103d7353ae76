"""Static rewrites against recorded pairs: ``<name>_original`` and ``<name>_static_optimized`` in one folder."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

from drydock.operators import rewrite

FOLDER = os.environ.get("DRYDOCK_GOLDEN_DIR", "")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="DRYDOCK_GOLDEN_DIR names no folder of recorded pairs")


def pairs():
    first = "_original"
    for path in sorted(Path(FOLDER or "/nonexistent").glob(f"*{first}")):
        done, model = (path.with_name(path.name.removesuffix(first) + x) for x in ("_static_optimized", "_llm_optimized"))
        if model.exists() and model.read_bytes() == path.read_bytes():
            continue  # the original was overwritten by a later stage: the files are not of one run
        yield path.name.removesuffix(first), path.read_text(encoding="utf-8"), done.read_text(encoding="utf-8") if done.exists() else None


def test_recorded_rewrites(spark):
    rows = list(pairs())
    assert rows
    df = spark.createDataFrame([(n, a) for n, a, _ in rows], "file_id string, content string")
    got = {r["file_id"]: (r["rewritten"], r["changed"]) for r in rewrite.static_rewrite(df).collect()}
    wrong = [n for n, a, b in rows if got[n] != ((b, True) if b is not None else (a, False))]
    assert not wrong
