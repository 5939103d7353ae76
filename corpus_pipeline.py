"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept. Stages are
written to the shared folder and read back, so none is computed twice; the tables inside a stage, and the stage before, are removed
when it stands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drydock.llm import common, decontamination, line_dedup, minhash, packing, quality_rules

#: Token runs that a worker remembers, some 60 MB: less than by default, since executors still hold the heap of the stages before.
REMEMBERED = 250_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside the compression bands go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines the first stays; a document of which no line stays goes."""
    left = line_dedup.remove_repeats(docs)
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays; shingles of five words, as near-duplicate stages have."""
    return minhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which a benchmark item leaks go."""
    return decontamination.keep_clean(docs, common.table(spark, sf_dir, "benchmark"), scripts=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of the documents that are left."""
    return packing.pack(docs, remembered=REMEMBERED)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("packed", packed),
]

#: Compression and token ids have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = common.last_only(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            common.discard(before)
        before = docs
    return docs
