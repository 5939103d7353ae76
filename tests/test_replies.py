from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from drydock.functions import replies as rp
from drydock.operators import replies, scorecard

FULL = {
    "security_risks": ["a {brace}", "b"],
    "performance_issues": ["slow [x]"],
    "best_practices_missing": [],
    "estimated_wasted_space_kb": 12.5,
    "complexity_score": 3,
    "recommendations": [{"category": "security", "severity": "high", "message": "m", "instruction_line": 2}],
    "overall_assessment": "fine",
}


def parse(spark, *raws, **kw):
    df = spark.createDataFrame(list(enumerate(raws)), "id long, raw string")
    return replies.normalise(df, **kw).orderBy("id").collect()


def test_shapes(spark):
    text = json.dumps(FULL)
    rows = parse(
        spark,
        text,
        f"```json\n{text}\n```",
        f"Sure:\n```\n{text}\n```\ntrailing",
        text + "\n} more",
        "LLM API error: 429",
        "Error: down",
        "plain words",
        "",
        None,
        "[1, 2]",
        "{'single': 1}",
    )
    assert [r.status for r in rows] == ["ok"] * 4 + ["api_error"] * 2 + ["parse_error", "ok", "ok"] + ["parse_error"] * 2
    for r in rows[:4]:
        assert r.data.security_risks == ["a {brace}", "b"] and r.data.complexity_score == 3.0
        assert r.data.maintainability_score == 5.0 and r.data.recommendations[0].instruction_line == 2
    assert rows[7].data.security_risks == [] and rows[7].data.estimated_wasted_space_kb == 0.0
    assert rows[4].error == "LLM API error: 429" and rows[0].error is None


def test_nulls_and_wrong_types_get_defaults(spark):
    r = parse(spark, '{"security_risks": null, "complexity_score": "high", "estimated_wasted_space_kb": null}')[0]
    assert r.status == "ok" and r.data.security_risks == [] and r.data.complexity_score == 5.0
    assert r.data.estimated_wasted_space_kb == 0.0


def test_missing_braces_are_closed(spark):
    rows = parse(spark, '{"security_risks": ["a"]', '{"x": {"y": 1}, "security_risks": ["a"]')
    assert [r.data.security_risks for r in rows] == [["a"], ["a"]]
    # an open list: its closing sign goes before the one brace that is kept
    assert parse(spark, '{"security_risks": ["a", "b"')[0].data.security_risks == ["a", "b"]


def test_salvage(spark):
    broken = '{"security_risks": ["a", "b"], "performance_issues": ["p"], "x": "cut'
    r = parse(spark, broken)[0]
    assert (r.status, r.data.security_risks, r.data.performance_issues) == ("partial", ["a", "b"], ["p"])
    r = parse(spark, '{"performance_issues": ["p"], "security_risks": ["a", "cu')[0]
    assert (r.status, r.data.security_risks, r.data.performance_issues) == ("partial", [], ["p"])
    assert parse(spark, '{"security_risks": ["a')[0].status == "parse_error"


def test_salvage_window(spark):
    long = json.dumps(["x" * 500] * 10)
    broken = f'{{"security_risks": {long}, "y": "cut'
    assert len(parse(spark, broken)[0].data.security_risks) == 10
    assert parse(spark, broken, window=2000)[0].status == "parse_error"


@pytest.mark.parametrize(
    ("error", "expected"),
    [(None, None), ("code 429", "quota"), ("Quota gone", "quota"), ("403 by moderation", "moderation"), ("403", "other"), ("401", "bad_key"), ("Invalid key", "bad_key"), ("x", "other")],
)
def test_error_class(spark, error, expected):
    df = spark.createDataFrame([(error,)], "e string")
    assert df.select(rp.error_class(F.col("e"))).first()[0] == expected


@pytest.mark.parametrize(
    ("raw", "fixed", "status"),
    [
        ("FROM b\nRUN x", "FROM b\nRUN x", "ok"),
        ("Here:\n```dockerfile\nFROM b\n\n# c\nRUN x\n```\n", "FROM b\n\n# c\nRUN x", "ok"),
        ("intro\n# FROM no\nfrom b\nRUN x\n```\nlost", "from b\nRUN x", "ok"),
        ("use RUN x\nnothing\nand copy y", "use RUN x\nand copy y", "ok"),
        ("just words", "just words", "ok"),
        ("FROM a\nRUN y", None, "no_change"),
        ("", None, "no_change"),
        ("LLM API error: x", None, "api_error"),
    ],
)
def test_fixed_files(spark, file_of, raw, fixed, status):
    df = spark.createDataFrame([(0, raw)], "file_id long, raw string")
    r = replies.fixed_files(df, file_of("FROM a\nRUN y")).first()
    assert (r.status, r.fixed) == (status, fixed)


def test_call_model_reports_errors_as_text(spark):
    def model(prompt):
        if "bad" in prompt:
            raise ValueError("no")
        return prompt.upper()

    df = spark.createDataFrame([(1, "ok"), (2, "bad")], "file_id long, prompt string")
    assert {r.file_id: r.raw for r in replies.call_model(df, model).collect()} == {1: "OK", 2: "LLM API error: no"}


def test_prompt_shows_bounded_lists(spark, file_of):
    many = dict(FULL, security_risks=[f"r{i}" for i in range(12)], recommendations=[{"message": f"m{i}"} for i in range(17)])
    df = spark.createDataFrame([(0, json.dumps(many))], "file_id long, raw string")
    scored = scorecard.score(replies.normalise(df, "file_id"))
    prompt = replies.fix_prompts(scored, file_of("FROM a")).first().prompt
    assert "10. r9\n" in prompt and "r10" not in prompt and "Security risks (12)" in prompt
    assert "[MEDIUM] general: m14\n" in prompt and "m15" not in prompt and "FROM a" in prompt


def test_scores_and_parity(spark):
    raws = [json.dumps({"security_risks": ["x"] * 9, "performance_issues": ["y"] * 2, "best_practices_missing": ["z"]}), "bad"]
    df = spark.createDataFrame(list(enumerate(raws)), "id long, raw string")
    analysed = replies.normalise(df)
    ok, failed = [r.scores for r in scorecard.score(analysed).orderBy("id").collect()]
    assert (ok.security, ok.efficiency, ok.best_practices, ok.overall) == (0.0, 82.0, 88.0, 59.2)
    assert failed is None
    assert scorecard.score(analysed, parity=True).orderBy("id").collect()[1].scores.overall == 100.0


def analyses(spark, *raws):
    df = spark.createDataFrame(list(enumerate(raws)), "file_id long, raw string")
    return scorecard.score(replies.normalise(df, "file_id"))


def test_issue_changes_and_improvements(spark):
    before = analyses(spark, json.dumps({"security_risks": ["a", "a", "b"], "performance_issues": ["p"]}))
    after = analyses(spark, json.dumps({"security_risks": ["b", "c"]}))
    both = scorecard.compare(before, after)
    rows = {r.section: r for r in scorecard.issue_changes(both).collect()}
    s = rows["security_risks"]
    assert (s.original_count, s.fixed_count, s.fixed, s.new, s.remaining) == (2, 2, ["a"], ["c"], ["b"])
    assert rows["performance_issues"].all_resolved and not rows["missing_practices"].all_resolved
    for r in rows.values():
        assert len(r.fixed) + len(r.remaining) == r.original_count
    imp = {r.score_key: r for r in scorecard.improvements(both).collect()}
    assert (imp["security"].original, imp["security"].fixed, imp["security"].improvement, imp["security"].percent_change) == (64.0, 76.0, 12.0, 18.8)


def test_scorecard_stages(spark):
    files = spark.createDataFrame([(i, f"u{i // 2}", None if i == 4 else f"p{i}") for i in range(5)], "file_id long, repo_url string, path string")
    good = json.dumps({"security_risks": ["a"]})
    before = analyses(spark, good, "bad", good, good)
    fixes = spark.createDataFrame([(0, "ok"), (2, "no_change"), (3, "ok")], "file_id long, status string")
    after = analyses(spark, "{}")
    card = scorecard.scorecard(files, before, fixes, after)
    rows = {r.file_id: r for r in card.collect()}
    assert len(card.columns) == 30
    assert (rows[0].original_security, rows[0].fixed_security, rows[0].improvement_security) == (88.0, 100.0, 12.0)
    assert (rows[0].security_risks_before, rows[0].security_risks_after) == (1, 0)
    assert rows[1].llm_error and rows[1].original_overall is None and rows[1].fix_error is None
    assert rows[2].fix_error and rows[2].fixed_overall is None and rows[2].original_security == 88.0
    assert rows[3].validation_error and rows[3].fixed_security == 88.0 and rows[3].improvement_security is None
    assert rows[4].llm_error == "No build file found" and rows[4].path == ""
    meta = scorecard.run_metadata(card).first()
    assert (meta.repo_count, meta.dockerfile_count) == (3, 5)
    assert {r.file_id for r in scorecard.stage_success(card).filter("success").collect()} == {0, 3}


def test_top_recommendations(spark):
    recs = [{"category": "security", "message": f"s{i}"} for i in range(7)] + [{"category": "other"}, {"category": "optimization", "severity": "low"}]
    rows = replies.top_recommendations(replies.normalise(spark.createDataFrame([(0, json.dumps({"recommendations": recs}))], "id long, raw string"))).collect()
    assert [(r.category, r.n_total, r.rank, r.severity, r.message) for r in rows] == [
        ("security", 7, i + 1, "medium", f"s{i}") for i in range(5)
    ] + [("optimization", 1, 1, "low", "")]


def test_size_issues_keep_duplicates_and_skip_upper_case_words(spark):
    data = {"performance_issues": ["Cache x", "Cache x", "COPY late"], "optimization_opportunities": ["smaller base"]}
    df = spark.createDataFrame([(0, json.dumps(data))], "id long, raw string")
    assert [r.issue for r in replies.model_size_issues(replies.normalise(df)).collect()] == ["Cache x", "Cache x", "smaller base"]
