"""What has been done, so that it is not done again.

The keys of finished work are a table that is committed together with the results of the run (``sources.commits``): a
run that breaks adds neither, and repeated it does the same work once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import commits
from .rows import maybe_in

KEYS, RESULTS = "keys", "results"
#: Segments of keys that are merged into one.
SEGMENTS = 32


def _schema(df: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)


def pending(work: DataFrame, folder: str, keys: Sequence[str]) -> DataFrame:
    """The rows of ``work`` whose keys are not in the ledger; a null is a key like any other.

    A bitmap of the work's keys first leaves out most of the ledger, which grows with all that was ever done; an exact
    anti-join follows.
    """
    done = commits.read(work.sparkSession, folder, KEYS, _schema(work, keys))
    near = maybe_in(done, keys, work)
    other = near.distinct().withColumnsRenamed({k: f"_done_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & work[k].eqNullSafe(F.col(f"_done_{k}"))
    return work.join(other, same, "left_anti")


def finish(results: DataFrame, folder: str, keys: Sequence[str]) -> None:
    """Commits the results of a run and their keys together, and merges the keys when there are many segments."""
    spark = results.sparkSession
    written = commits.write_segment(results, folder, RESULTS)
    stored = spark.read.schema(results.schema).parquet(f"{folder}/{written}")
    done = commits.write_segment(stored.select(*keys).distinct(), folder, KEYS)
    commits.commit(spark, folder, append={RESULTS: written, KEYS: done})
    if len(commits.segments(spark, folder)[KEYS]) > SEGMENTS:
        every = commits.read(spark, folder, KEYS, _schema(results, keys)).distinct()
        commits.commit(spark, folder, replace={KEYS: commits.write_segment(every, folder, KEYS)})
