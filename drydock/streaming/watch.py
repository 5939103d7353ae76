"""Watch mode: audit snapshot documents as they arrive."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators import containers, images


def trigger(writer: DataStreamWriter, every_seconds: float | None) -> DataStreamWriter:
    """None drains what is there and stops; a number polls at that interval."""
    if every_seconds is None:
        return writer.trigger(availableNow=True)
    if every_seconds <= 0:
        raise ValueError("the watch interval must be positive")
    return writer.trigger(processingTime=f"{every_seconds} seconds")


def milliseconds(interval: str) -> int:
    """``10 minutes`` and the like."""
    return int(pd.Timedelta(interval).total_seconds() * 1000)


_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_keyed(writer: DataStreamWriter, spark: SparkSession, every_seconds: float | None) -> StreamingQuery:
    """Starts a query with timers, whose state is kept on disk; other queries of the session keep their store."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        return trigger(writer, every_seconds).start()
    finally:
        spark.conf.set(_STORE, before)


def watch_containers(
    snapshots: DataFrame, sink: str, checkpoint: str, keys: list[str], every_seconds: float | None = None
) -> StreamingQuery:
    """Append the findings of each arriving ``snapshots(keys, doc)`` row to a parquet sink.

    A map over rows: no state, so the rate grows with the executors. The file sink's commit log
    makes a restarted run exactly-once.
    """
    found = containers.container_findings(snapshots, keys)
    return trigger(to_parquet(found, sink, checkpoint), every_seconds).start()


def watch_images(snapshots: DataFrame, sink: str, checkpoint: str, every_seconds: float | None = None) -> StreamingQuery:
    found = images.image_findings(snapshots)
    return trigger(to_parquet(found, sink, checkpoint), every_seconds).start()


def to_parquet(df: DataFrame, sink: str, checkpoint: str) -> DataStreamWriter:
    return df.writeStream.format("parquet").outputMode("append").option("path", sink).option(
        "checkpointLocation", checkpoint
    )


def finding_counts(found: DataFrame, time: str, width: str = "1 hour", late: str = "10 minutes", once: list[str] | None = None) -> DataFrame:
    """Findings per rule and event-time window; a closed window is final.

    Findings that agree in ``once`` are deliveries of one: in a stream those that come within ``late`` of each other, which
    bounds the state, in a batch all. In a stream findings later than ``late`` are left out.
    """
    marked = found.withWatermark(time, late)
    if once:
        marked = marked.dropDuplicatesWithinWatermark(once) if found.isStreaming else marked.dropDuplicates(once)
    return (
        marked.groupBy(F.window(time, width), "rule_id")
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), "rule_id", "n")
    )


def watch_counts(
    found: DataFrame, sink: str, checkpoint: str, time: str, width: str, late: str, once: list[str], every_seconds: float | None = None
) -> StreamingQuery:
    """Append the counts of each window to a parquet sink when it closes."""
    return trigger(to_parquet(finding_counts(found, time, width, late, once), sink, checkpoint), every_seconds).start()
