"""Output tables. All of them are written by the executors; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import commits
from .files import file_system


SCORES, METADATA = "scores", "run_metadata"


def write_scorecard(card: DataFrame, metadata: Callable[[DataFrame], DataFrame], path: str, fmt: str = "parquet") -> None:
    """Two tables, ``scores`` and ``run_metadata``, that appear together; the metadata is made from the scores as written.

    ``csv`` also writes them as CSV with a header, from what has been committed.
    """
    spark, runs = card.sparkSession, f"{path}/_runs"
    scores = commits.write_segment(card, runs, SCORES)
    written = spark.read.schema(card.schema).parquet(f"{runs}/{scores}")
    commits.commit(spark, runs, replace={SCORES: scores, METADATA: commits.write_segment(metadata(written), runs, METADATA)})
    if fmt == "csv":
        for name, table in zip((SCORES, METADATA), read_scorecard(spark, path), strict=True):
            table.write.mode("overwrite").option("header", "true").option("escape", '"').csv(f"{path}/{name}")


def read_scorecard(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The scores and the metadata of the last run that ended."""
    found = commits.segments(spark, f"{path}/_runs")
    return tuple(spark.read.parquet(*[f"{path}/_runs/{name}" for name in found[table]]) for table in (SCORES, METADATA))


def write_results(results: DataFrame, path: str) -> None:
    """Result CSV with a header; nulls become empty cells."""
    results.write.mode("overwrite").option("header", "true").option("escape", '"').option("quoteAll", "false").csv(path)


def write_stage_texts(stages: DataFrame, path: str) -> None:
    """The text of each stage, one folder per stage."""
    stages.write.mode("overwrite").partitionBy("stage").parquet(path)


def write_sorted_lines(df: DataFrame, column: str, path: str) -> None:
    """Text lines in order over all part files (a range-partitioned sort)."""
    df.select(F.col(column).cast("string").alias("value")).orderBy("value").write.mode("overwrite").text(path)


def write_files(df: DataFrame, folder: str) -> None:
    """Each row of ``df(path, content)`` as a file below ``folder``, written by the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                fs, name, _ = file_system(f"{folder}/{path}")
                if name.rpartition("/")[0] != last:
                    last = name.rpartition("/")[0]
                    fs.create_dir(last, recursive=True)
                with fs.open_output_stream(name) as f:
                    f.write((content or "").encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    df.select("path", "content").mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()


def write_json(df: DataFrame, path: str) -> None:
    """Nested rows as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_rows(df: DataFrame, path: str) -> None:
    """Selected rows with their input columns as CSV."""
    write_results(df, path)
