"""Prompts out, replies in: the model is a table boundary.

``prompts`` are written for a model run elsewhere, ``responses(id, raw)`` are read back. A callable
can be plugged in between with ``call_model``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import replies as rp
from ..sources import commits
from .rows import hold, unfold

# List lengths in the prompt.
ISSUES_SHOWN, RECOMMENDATIONS_SHOWN = 10, 15
NO_FIX = "No new build file in the reply"
PROMPT_LISTS = (
    ("Security risks", "security_risks"),
    ("Performance issues", "performance_issues"),
    ("Optimisation options", "optimization_opportunities"),
    ("Missing practices", "best_practices_missing"),
)


def analysis_prompts(files: DataFrame, key: str = "file_id") -> DataFrame:
    """One analysis prompt per file, asking for the reply fields as one JSON object."""
    asked = ", ".join([*rp.LIST_FIELDS, *rp.NUMBER_DEFAULTS, "overall_assessment", "recommendations"])
    head = f"Review the container build file below. Reply with one JSON object with the fields {asked}.\n\n"
    return files.select(key, F.concat(F.lit(head), F.col("content"), F.lit("\n")).alias("prompt"))


def fix_prompts(analyses: DataFrame, files: DataFrame, key: str = "file_id") -> DataFrame:
    """One prompt per analysed file with its scores, the first issues of each list and the first
    recommendations. ``analyses(file_id, data, scores)``."""

    def numbered(title: str, field: str) -> Column:
        items = F.transform(
            F.slice(F.col("data")[field], 1, ISSUES_SHOWN),
            lambda t, i: F.concat((i + 1).cast("string"), F.lit(". "), t, F.lit("\n")),
        )
        return F.concat(
            F.lit(f"\n{title} ("), F.size(F.col("data")[field]).cast("string"), F.lit("):\n"), F.array_join(items, "")
        )

    recommendation = F.transform(
        F.slice(F.col("data.recommendations"), 1, RECOMMENDATIONS_SHOWN),
        lambda r: F.concat(
            F.lit("- ["),
            F.upper(F.coalesce(r["severity"], F.lit("medium"))),
            F.lit("] "),
            F.coalesce(r["category"], F.lit("general")),
            F.lit(": "),
            F.coalesce(r["message"], F.lit("")),
            F.when(F.coalesce(r["instruction_line"], F.lit(0)) != 0, F.concat(F.lit(" (line "), r["instruction_line"].cast("string"), F.lit(")"))).otherwise(""),
            F.lit("\n"),
        ),
    )
    n_rec = F.size("data.recommendations")
    summary = F.concat(
        *[
            F.concat(F.lit(f"{name}: "), F.col(f"scores.{name}").cast("string"), F.lit("/100\n"))
            for name in ("security", "efficiency", "best_practices", "overall")
        ],
        *[numbered(title, field) for title, field in PROMPT_LISTS],
        F.when(
            n_rec > 0, F.concat(F.lit("\nRecommendations ("), n_rec.cast("string"), F.lit("):\n"), F.array_join(recommendation, ""))
        ).otherwise(""),
    )
    head = "Correct only the issues listed and return the whole build file as plain text.\n\n"
    with_summary = analyses.select(key, summary.alias("summary"))
    return with_summary.join(files.select(key, "content"), key).select(
        key, F.concat(F.lit(head), F.col("content"), F.lit("\n\n"), F.col("summary")).alias("prompt")
    )


def call_model(prompts: DataFrame, complete: Callable[[str], str], key: str = "file_id") -> DataFrame:
    """``key, raw`` by calling ``complete(prompt)`` for each prompt in Arrow batches.

    An exception becomes an error text, never a failed task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for prompt in batch["prompt"]:
                try:
                    texts.append(complete(prompt))
                except Exception as exc:  # noqa: BLE001 - the boundary reports every failure as text
                    texts.append(f"LLM API error: {exc}")
            yield pd.DataFrame({key: batch[key], "raw": texts})

    schema = f"{key} {prompts.schema[key].dataType.simpleString()}, raw string"
    return prompts.select(key, "prompt").mapInPandas(run, schema)


ANSWERS = "answers"
_ANSWER = "prompt_hash string, raw string, ok boolean"


def _asked(complete: Callable[[str], str], attempts: int, transient: tuple[type[Exception], ...], pause: float):
    def ask(prompt: str) -> tuple[str, bool]:
        for k in range(attempts):
            try:
                return complete(prompt), True
            except transient as exc:
                error = exc
                if k + 1 < attempts:
                    time.sleep(pause * 2**k)
            except Exception as exc:  # noqa: BLE001 - the boundary reports every failure as text
                error = exc
                break
        return f"LLM API error: {error}", False

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [ask(p) for p in batch["prompt"]]
            yield pd.DataFrame({"prompt_hash": batch["prompt_hash"], "raw": [a for a, _ in answers], "ok": [ok for _, ok in answers]})

    return run


def ask_once(
    prompts: DataFrame,
    complete: Callable[[str], str],
    folder: str,
    key: str = "file_id",
    callers: int = 8,
    attempts: int = 3,
    transient: tuple[type[Exception], ...] = (TimeoutError, ConnectionError),
    pause: float = 1.0,
) -> DataFrame:
    """``key, raw``: each different prompt is asked once, by ``callers`` tasks at a time, and its answer kept in ``folder``.

    Prompts that have an answer there are not asked again. Errors of a ``transient`` class are tried ``attempts`` times, the
    pauses doubling; what fails in the end becomes an error text, is not kept as an answer, and is asked again in the next run.
    """
    spark = prompts.sparkSession
    text = F.coalesce("prompt", F.lit(""))
    named = prompts.select(key, text.alias("prompt"), F.sha2(text, 256).alias("prompt_hash"))
    known = commits.read(spark, folder, ANSWERS, _ANSWER).filter("ok").select("prompt_hash")
    different = named.select("prompt_hash", "prompt").dropDuplicates(["prompt_hash"])
    fresh = different.join(known, "prompt_hash", "left_anti").repartition(callers, "prompt_hash")
    written = commits.write_segment(fresh.mapInPandas(_asked(complete, attempts, transient, pause), _ANSWER), folder, ANSWERS)
    failed = spark.read.schema(_ANSWER).parquet(f"{folder}/{written}").filter("not ok")
    commits.commit(spark, folder, append={ANSWERS: written})
    answers = commits.read(spark, folder, ANSWERS, _ANSWER).filter("ok").unionByName(failed).select("prompt_hash", "raw")
    return named.join(answers.dropDuplicates(["prompt_hash"]), "prompt_hash").select(key, "raw")


def normalise(responses: DataFrame, key: str = "id", window: int | None = None) -> DataFrame:
    """``key, status, error, data``.

    ``status`` is ok, partial (only the salvaged lists are known), api_error or parse_error; ``data``
    always holds every field, missing and null ones with their defaults. Salvage runs only for
    replies that did not parse.
    """
    raw = F.coalesce("raw", F.lit(""))
    read = responses.select(key, raw.alias("raw"), rp.is_api_error(raw).alias("api_error"))
    text = F.when(F.trim("raw") == "", F.lit("{}")).otherwise(rp.unfenced(F.col("raw")))
    cleaned = read.select(key, "raw", "api_error", F.when(~F.col("api_error"), text).alias("text"))
    walked = cleaned.select("*", rp.brace_walk(F.col("text")).alias("walk"))
    closed = rp.balanced(F.col("text"), F.col("walk"))
    parsed = walked.select(
        key, "raw", "api_error", F.when(F.col("text").startswith("{"), F.try_parse_json(closed)).alias("v")
    )
    failed = ~F.col("api_error") & F.col("v").isNull()
    tails = parsed.select(
        "*", *[F.when(failed, rp.salvage_tail(F.col("raw"), f, window)).alias(f"tail_{f}") for f in rp.SALVAGE_FIELDS]
    )
    saved = tails.select(
        key, "raw", "api_error", "v", *[rp.salvage_list(F.col(f"tail_{f}")).alias(f"saved_{f}") for f in rp.SALVAGE_FIELDS]
    )
    any_saved = F.lit(False)
    for f in rp.SALVAGE_FIELDS:
        any_saved = any_saved | F.col(f"saved_{f}").isNotNull()

    def list_field(name: str) -> Column:
        value = F.try_variant_get("v", f"$.{name}", "array<string>")
        known = [value, F.col(f"saved_{name}")] if name in rp.SALVAGE_FIELDS else [value]
        return F.coalesce(*known, F.array().cast("array<string>")).alias(name)

    data = F.struct(
        *[list_field(f) for f in rp.LIST_FIELDS],
        *[F.coalesce(F.try_variant_get("v", f"$.{f}", "double"), F.lit(d)).alias(f) for f, d in rp.NUMBER_DEFAULTS.items()],
        F.coalesce(F.try_variant_get("v", "$.overall_assessment", "string"), F.lit("")).alias("overall_assessment"),
        F.coalesce(F.try_variant_get("v", "$.recommendations", rp.RECOMMENDATION), F.array().cast(rp.RECOMMENDATION)).alias(
            "recommendations"
        ),
    )
    status = (
        F.when(F.col("api_error"), F.lit("api_error"))
        .when(F.col("v").isNotNull(), F.lit("ok"))
        .when(any_saved, F.lit("partial"))
        .otherwise(F.lit("parse_error"))
    )
    error = F.when(F.col("api_error"), F.col("raw")).when(failed & ~any_saved, F.lit("The reply is not valid JSON"))
    # Through a generator, so that filters on the result do not copy the parsing below themselves.
    result = F.struct(status.alias("status"), error.alias("error"), data.alias("data"))
    return hold(saved, [key], result, "_r").select(key, "_r.*")


def succeeded(status: Column) -> Column:
    return status.isin("ok", "partial")


def fixed_files(responses: DataFrame, originals: DataFrame, key: str = "file_id", errors: bool = False) -> DataFrame:
    """``key, status, fixed``: the build file in each reply, kept when it is new and not blank.

    New texts are told from the originals by their hashes, so only replies' own texts are carried.
    ``errors`` adds ``fix_error``: what went wrong, if anything.
    """
    lines = responses.select(
        key,
        rp.is_api_error(F.coalesce("raw", F.lit(""))).alias("api_error"),
        F.split(rp.without_fences(F.coalesce("raw", F.lit(""))), "\n").alias("lines"),
        F.when(rp.is_api_error(F.coalesce("raw", F.lit(""))), F.col("raw")).alias("api_text"),
    )
    extracted = lines.select(key, "api_error", "api_text", rp.buildfile_lines(F.col("lines")).alias("fixed"))
    hashed = originals.select(key, F.sha2("content", 256).alias("_old"))
    joined = extracted.withColumn("_new", F.sha2("fixed", 256)).join(hashed, key)
    real = (F.col("fixed") != "") & (F.col("_new") != F.col("_old"))
    status = F.when(F.col("api_error"), F.lit("api_error")).when(real, F.lit("ok")).otherwise(F.lit("no_change"))
    out = [key, status.alias("status"), F.when(status == "ok", F.col("fixed")).alias("fixed")]
    if errors:
        out.append(F.when(status == "api_error", F.col("api_text")).when(status == "no_change", F.lit(NO_FIX)).alias("fix_error"))
    return joined.select(*out)


def top_recommendations(analyses: DataFrame, k: int = 5, key: str = "id") -> DataFrame:
    """``key, category, n_total, rank, severity, message``: the first ``k`` per category, categories in
    report order. Lists sit in their row, so this is a slice, not a window."""
    categories = F.array(*[F.lit(c) for c in ("security", "performance", "best_practice", "optimization")])
    grouped = F.transform(
        categories,
        lambda c: F.struct(
            c.alias("category"), F.filter(F.col("data.recommendations"), lambda r: r["category"] == c).alias("recs")
        ),
    )
    per_category = unfold(analyses, [key], grouped, "g").select(key, "g.category", F.size("g.recs").alias("n_total"), "g.recs")
    ranked = unfold(per_category, [key, "category", "n_total"], F.slice("recs", 1, k), "r", pos="pos")
    return ranked.select(
        key,
        "category",
        "n_total",
        (F.col("pos") + 1).alias("rank"),
        F.coalesce("r.severity", F.lit("medium")).alias("severity"),
        F.coalesce("r.message", F.lit("")).alias("message"),
    )


def top_issues(analyses: DataFrame, k: int = 5, key: str = "id") -> DataFrame:
    """``key, list_name, n_total, rank, issue``: the first ``k`` of each issue list."""
    lists = F.array(
        *[F.struct(F.lit(f).alias("list_name"), F.col("data")[f].alias("issues")) for f in rp.LIST_FIELDS]
    )
    per_list = unfold(analyses, [key], lists, "_l").select(
        key, "_l.list_name", F.size("_l.issues").alias("n_total"), "_l.issues"
    )
    ranked = unfold(per_list, [key, "list_name", "n_total"], F.slice("issues", 1, k), "issue", pos="pos")
    return ranked.select(key, "list_name", "n_total", (F.col("pos") + 1).alias("rank"), "issue")


def model_size_issues(analyses: DataFrame, key: str = "id", words: tuple[str, ...] = rp.SIZE_WORDS) -> DataFrame:
    """``key, issue``: performance issues, then optimisation options, that speak of size."""
    both = F.concat("data.performance_issues", "data.optimization_opportunities")
    return unfold(analyses, [key], rp.size_issues(both, words), "issue", pos="pos")
