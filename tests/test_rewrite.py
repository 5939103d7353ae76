from __future__ import annotations

import pytest

from drydock.operators import rewrite

CLEAN = "&& rm -rf /var/lib/apt/lists/*"


def run(files, **kw):
    return [(r.rewritten, r.changed, r.n_changes) for r in rewrite.static_rewrite(files, **kw).orderBy("file_id").collect()]


def test_flags_and_cleanup(file_of):
    text = "FROM a\nRUN apt-get update && apt-get install -y x  \nRUN pip install y\n# pip install z\n"
    new = f"FROM a\nRUN apt-get update && apt-get install --no-install-recommends -y x {CLEAN}\nRUN pip install --no-cache-dir y\n# pip install --no-cache-dir z\n"
    assert run(file_of(text)) == [(new, True, 4)]


def test_untouched_text(file_of):
    text = "FROM a\nRUN make && true\n"
    assert run(file_of(text)) == [(text, False, 0)]


def test_rule_must_fire(file_of):
    # the only install is in a comment: no rule fires, nothing is rewritten
    text = "FROM a\n# RUN apt-get install x && y\n"
    assert run(file_of(text)) == [(text, False, 0)]


def test_continued_line_gets_a_cleanup_line(file_of):
    text = "RUN apt-get update && apt-get install -y \\\n  x"
    new = f"RUN apt-get update && apt-get install --no-install-recommends -y \\\n    {CLEAN} \\\n  x"
    assert run(file_of(text)) == [(new, True, 2)]


def test_safe_cleanup_goes_to_the_end_of_the_command(file_of):
    text = "RUN apt-get update && apt-get install -y \\\n  x\nCMD y"
    new = f"RUN apt-get update && apt-get install --no-install-recommends -y \\\n  x {CLEAN}\nCMD y"
    assert run(file_of(text), safe_cleanup=True) == [(new, True, 2)]


def test_neighbour_lines_count_as_cleaned(file_of):
    text = "RUN apt-get install --no-install-recommends x && a \\\n && b \\\n && rm -rf /var/lib/apt/lists/x\nRUN apt-get update && true"
    assert run(file_of(text)) == [(text, False, 0)]


def test_dangling_lines_are_logged_per_finding(file_of):
    # two clean-up findings; the dangling line is logged twice, edited never
    text = "RUN apt-get install --no-install-recommends a &&\n\n\n\nRUN apt-get install --no-install-recommends b && c"
    rewritten, changed, n = run(file_of(text))[0]
    assert changed and rewritten.split("\n")[0].endswith("&&") and n == 1 + 2


@pytest.mark.parametrize("safe", [False, True])
def test_second_pass_changes_nothing(spark, file_of, safe):
    text = (
        "FROM a\nRUN apt-get update && apt-get install -y \\\n x \\\n y\nRUN pip install q && apt-get install z\n"
        "RUN apt-get install b && \\\n apt-get install c && true\n"
    )
    first = rewrite.static_rewrite(file_of(text), safe_cleanup=safe).first().rewritten
    assert first != text
    again = rewrite.static_rewrite(file_of(first), safe_cleanup=safe).first()
    assert again.rewritten == first and again.n_changes == 0


def test_stage_texts(spark, file_of):
    done = rewrite.static_rewrite(file_of("FROM a\nRUN pip install x", "FROM b"))
    model = spark.createDataFrame([(0, "FROM c"), (1, "FROM b")], "file_id long, content string")
    rows = {(r.file_id, r.stage) for r in rewrite.stage_texts(done, model).collect()}
    assert rows == {(0, "original"), (0, "static_optimized"), (0, "llm_optimized"), (1, "original")}


def test_keep_real_rewrites(spark):
    df = spark.createDataFrame([("a", "a"), ("a", ""), ("a", None), ("a", "b")], "x string, y string")
    assert [r.y for r in rewrite.keep_real_rewrites(df, "x", "y").collect()] == ["b"]


@pytest.mark.parametrize("blanks", [" " * 100, "\t \r" * 50, "\n" * 90, " \n\t\n" * 40])
def test_a_continuation_of_any_length(file_of, blanks):
    text = f"FROM a\nRUN apt-get update && apt-get install -y \\{blanks}\n  x\nRUN apt-get install y && z"
    new = text.replace("install ", "install --no-install-recommends ").replace("  x\n", "  x && rm -rf /var/lib/apt/lists/*\n") + " && rm -rf /var/lib/apt/lists/*"
    assert run(file_of(text), safe_cleanup=True)[0][0] == new


def test_control_characters_stay(file_of):
    text = "FROM a\n# \x01 \x02a \x02\nRUN apt-get install x && y \\ \n \x01\x02b"
    got = run(file_of(text), safe_cleanup=True)[0][0]
    assert got == text.replace("install ", "install --no-install-recommends ") + " && rm -rf /var/lib/apt/lists/*"
