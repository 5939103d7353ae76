from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from drydock.functions import buildfile
from drydock.operators import lint


def parsed(files):
    rows = lint.instructions(files).orderBy("file_id", "idx").collect()
    return [(r.idx, r.instruction, r.value) for r in rows]


@pytest.mark.parametrize(
    ("content", "expected"),
    [
        ("", []),
        ("\n  \n# only a comment\n", []),
        ("FROM a:1\nRUN x", [(0, "FROM", "a:1"), (1, "RUN", "x")]),
        ("from a\r\nrun  x  y \r\n", [(0, "FROM", "a"), (1, "RUN", "x  y")]),
        ("RUN a \\\n  b \\\n  c", [(0, "RUN", "a b c")]),
        ("RUN a \\\n# note\n\n  b", [(0, "RUN", "a b")]),
        ("RUN a \\\n  b \\\n", []),
        ("RUN a\nRUN b \\", [(0, "RUN", "a")]),
        ("\\\nRUN a", [(0, "RUN", "a")]),
        ("ONBUILD", [(0, "ONBUILD", "")]),
        ("RUN a # tail\nRUN echo \"x # y\" # z", [(0, "RUN", "a"), (1, "RUN", 'echo "x # y"')]),
        ("RUN echo 'a\" # b", [(0, "RUN", "echo 'a\"")]),
        ("LABEL t=\"open # stays", [(0, "LABEL", "t=\"open # stays")]),
        ("# syntax=x/y:1\nFROM a", [(0, "SYNTAX", "# syntax=x/y:1"), (1, "FROM", "a")]),
        ("RUN a \\\n# SYNTAX=late\n  b", [(0, "SYNTAX", "# SYNTAX=late"), (1, "RUN", "a b")]),
        ("RUN a \\\n# syntax=late", [(0, "SYNTAX", "# syntax=late")]),
        ("RUN a\x0bRUN b RUN c", [(0, "RUN", "a"), (1, "RUN", "b"), (2, "RUN", "c")]),
        (" RUN　a ", [(0, "RUN", "a")]),
        ("RUN a #x \\\n  b", [(0, "RUN", "a"), (1, "B", "")]),
        ("RUN x \\ # c\n y", [(0, "RUN", "x y")]),
    ],
)
def test_instructions(file_of, content, expected):
    assert parsed(file_of(content)) == expected


def test_long_lines_do_not_overflow(file_of):
    content = "RUN " + "'a' \"b\" " * 50_000 + "# tail"
    rows = parsed(file_of(content))
    assert len(rows) == 1 and not rows[0][2].endswith("tail")


def test_index_is_dense_and_ordered(file_of):
    content = "\n".join(f"RUN step {i}" for i in range(300))
    assert [(i, v) for i, _, v in parsed(file_of(content))] == [(i, f"step {i}") for i in range(300)]


def test_file_names(spark):
    names = ["Dockerfile", "dockerfile", "DOCKERFILE.gpu", "Dockerfile.svg", "Dockerfile-x", "my.dockerfile", "dockerfiles"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    kept = [r.n for r in df.filter(buildfile.is_buildfile_name(F.col("n"))).collect()]
    assert kept == ["Dockerfile", "dockerfile", "DOCKERFILE.gpu", "Dockerfile.svg"]


@pytest.mark.parametrize(
    ("content", "ok"),
    [("", False), ("  \n", False), ("# FROM x", False), ("RUN a\n  from x", True), ("FROMAGE", True), ("<svg/>", False)],
)
def test_plausible(file_of, content, ok):
    assert file_of(content).select(buildfile.is_plausible(F.col("content"))).first()[0] is ok
