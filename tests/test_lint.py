from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from drydock.functions import rules
from drydock.operators import lint, savings

QUIET = "FROM a:1\nUSER u\nHEALTHCHECK CMD x\n"


def found(files):
    return {(r.idx, r.rule_id) for r in lint.findings(files).collect()}


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("FROM debian", {"from_unpinned"}),
        ("FROM debian:latest", {"from_unpinned"}),
        ("FROM debian:latest AS b", set()),
        ("FROM reg:5000/img", set()),
        ("RUN apt-get update && apt-get install -y x", {"apt_no_recommends", "apt_clean"}),
        ("RUN apt-get install --no-install-recommends x && apt-get  clean", set()),
        ("RUN apt-get install --no-install-recommends x && rm  -rf  /var/lib/apt/lists/*", set()),
        ("RUN apt update && true", {"apt_no_recommends", "apt_clean"}),
        ("RUN apt-get update", {"apt_no_recommends", "apt_clean", "apt_update_split", "combine_run"}),
        ("RUN pip install x && true", {"pip_cache"}),
        ("RUN pip install --no-cache-dir x && true", set()),
        ("RUN pip3 install x && true", set()),
        ("RUN wget -qO- u | sh && true", {"pipe_to_shell"}),
        ("RUN a", {"combine_run"}),
        ("ADD a /a", {"add_vs_copy"}),
        ("ADD a.tar.xz /a", set()),
        ("COPY a /a", set()),
    ],
)
def test_instruction_rules(file_of, line, expected):
    assert found(file_of(QUIET + line)) == {(3, r) for r in expected}


def test_file_rules(file_of):
    assert found(file_of("FROM a:1")) == {(-1, "no_user"), (-1, "no_healthcheck")}
    four = QUIET + "RUN a && b\n" * 3 + "RUN apt-get clean && apt-get install --no-install-recommends x"
    assert found(file_of(four)) == {(-1, "multi_stage")}
    assert found(file_of(QUIET + "RUN a && b\n" * 4)) == set()


def test_empty_and_missing_files(file_of):
    assert found(file_of("")) == {(-1, "no_user"), (-1, "no_healthcheck")}
    assert found(file_of(None)) == {(-1, "missing_file")}


def test_both_forms_agree(file_of):
    files = file_of(QUIET + "RUN apt-get update", "", None, "FROM x\nADD y /y\nRUN apt-get install a")
    rows = lint.findings(files).select("file_id", "idx", "rule_id", "severity").collect()
    arrays = lint.with_findings(files).select("file_id", F.inline("findings")).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, arrays))


def test_savings_per_rule():
    pinned = {"apt_no_recommends": 50000, "apt_clean": 10000, "apt_update_split": 20000, "pip_cache": 10000, "combine_run": 20000, "multi_stage": 100000}
    assert {r.rule_id: r.saving_kb for r in rules.RULES if r.saving_kb} == pinned
    assert {r.rule_id for r in rules.RULES if r.size_related} == set(pinned)
    assert not rules.BY_ID["add_vs_copy"].size_related


def test_savings_forms_agree(file_of):
    files = file_of(QUIET + "RUN apt-get update", QUIET, "FROM x\nRUN pip install a && b")
    a = savings.file_savings(lint.findings(files)).collect()
    b = savings.savings_in_row(files).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) == [(0, 4, 100000), (2, 1, 10000)]


def test_total_saving(spark):
    df = spark.createDataFrame([(10, None, True), (10, 5.0, False)], "s int, m double, failed boolean")
    fixed = [r[0] for r in df.select(savings.total_saving(F.col("s"), F.col("m"))).collect()]
    parity = [r[0] for r in df.select(savings.total_saving(F.col("s"), F.col("m"), True, F.col("failed"))).collect()]
    assert fixed == [10, 15] and parity == [0, 15]


def test_counts(file_of):
    rows = lint.counts(lint.findings(file_of("FROM a", "FROM b\nFROM c"))).collect()
    assert {(r.rule_id, r.n_findings, r.n_files) for r in rows} == {
        ("from_unpinned", 3, 2), ("no_user", 2, 2), ("no_healthcheck", 2, 2),
    }


def test_joined_error(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, "b"), (None, None)], "x string, y string")
    assert [r[0] for r in df.select(savings.joined_error(F.col("x"), F.col("y"))).collect()] == ["a; LLM: b", "a", "b", None]
