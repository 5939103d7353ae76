"""Reassembly of streamed completions: the whole text of each id, from chunks in any order.

A chunk that comes twice counts once. The batch and the streaming form give the same rows, also for
completions whose end has not come. ``close_completions`` gives each completion once, when it has ended or fallen silent, and
forgets it then.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .watch import milliseconds, start_keyed, to_parquet, trigger


def reassemble(chunks: DataFrame) -> DataFrame:
    """``id, text, n_chunks, finish_reason`` from ``chunks(id, seq, text, finish_reason)``.

    The chunks of one completion meet in one task: they make one text, which has to fit a row.
    """
    pieces = chunks.groupBy("id").agg(
        F.array_sort(F.collect_set(F.struct("seq", "text"))).alias("pieces"), F.max("finish_reason").alias("finish_reason")
    )
    return pieces.select(
        "id",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("text"),
        F.size("pieces").alias("n_chunks"),
        "finish_reason",
    )


def watch_completions(chunks: DataFrame, sink: str, checkpoint: str, every_seconds: float | None = None) -> StreamingQuery:
    """The same over a stream: each micro-batch writes the completions it changed, as they now are.

    The state is a native aggregate, one set of chunks per id. A batch that is run again overwrites its own
    rows. ``latest`` reads the sink.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    writer = reassemble(chunks).writeStream.outputMode("update").foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return trigger(writer, every_seconds).start()


def latest(spark: SparkSession, sink: str) -> DataFrame:
    """The last state of every completion in a sink."""
    rows = spark.read.parquet(sink)
    last = rows.groupBy("id").agg(F.max_by(F.struct("text", "n_chunks", "finish_reason"), "batch").alias("l"))
    return last.select("id", "l.*")


# --- completions that close --------------------------------------------------------------------------

_CLOSED = "text string, n_chunks int, finish_reason string, closed string"
_CLOSED_ROW = Row("id", *(x.split()[0] for x in _CLOSED.split(", ")))


def _millis(time: str) -> Column:
    return F.unix_millis(time).alias("at")


def close_completions(chunks: DataFrame, time: str, silence: str, late: str = "0 seconds") -> DataFrame:
    """``id, text, n_chunks, finish_reason, closed`` of each completion, once, when it closes; a batch or a stream.

    Chunks of an id that follow each other within ``silence`` are one completion. It closes as ``finish`` as soon as
    the chunk with a finish reason and all before it (``seq`` from 0) are there, and chunks that still come for it are dropped. Else it
    closes as ``timeout`` with the chunks it has, once nothing has come for it during ``silence``, seen from the latest time of
    all chunks less ``late``. Chunks with one ``seq`` are equal and count once. A stream drops chunks that come later than ``late``, and
    keeps nothing of a closed completion longer than ``silence`` after it.
    """
    millis = milliseconds(silence)
    rows = chunks.select("id", "seq", "text", "finish_reason", _millis(time), *([time] if chunks.isStreaming else []))
    if not chunks.isStreaming:
        return _closed_in_batch(rows, millis, milliseconds(late))
    kind = chunks.schema["id"].dataType.simpleString()
    return rows.withWatermark(time, late).groupBy("id").transformWithState(_Closing(millis), f"id {kind}, {_CLOSED}", "append", "eventTime")


def _closed_in_batch(rows: DataFrame, silence: int, late: int) -> DataFrame:
    by_time = Window.partitionBy("id").orderBy("at", "seq")
    gap = F.coalesce((F.col("at") - F.lag("at").over(by_time) > silence).cast("int"), F.lit(0))
    parts = rows.withColumn("_gap", gap).withColumn("_part", F.sum("_gap").over(by_time))
    pieces = F.array_sort(F.collect_set(F.struct("seq", "text")))
    ending = F.when(F.col("finish_reason").isNotNull(), F.col("seq"))
    whole = parts.groupBy("id", "_part").agg(
        pieces.alias("all"), F.min(ending).alias("end"), F.min_by("finish_reason", ending).alias("finish_reason"), F.max("at").alias("last")
    )
    upto = F.filter("all", lambda p: p["seq"] <= F.col("end"))
    finished = F.coalesce(F.size(upto) == F.col("end") + 1, F.lit(False))
    used = F.when(finished, upto).otherwise(F.col("all"))
    latest = rows.agg((F.max("at") - late).alias("_latest"))
    out = whole.withColumn("used", used).withColumn("closed", F.when(finished, "finish").otherwise("timeout")).crossJoin(latest)
    text = F.array_join(F.transform("used", lambda p: p["text"]), "").alias("text")
    return out.filter((F.col("closed") == "finish") | (F.col("last") + silence < F.col("_latest"))).select(
        "id", text, F.size("used").alias("n_chunks"), "finish_reason", "closed"
    )


class _Closing(StatefulProcessor):
    """The open chunks of an id, and the time up to which chunks belong to a completion that has closed.

    What an id has beside its chunks, its timer too, is one value, so that an id costs few looks at the state.
    """

    def __init__(self, silence: int):
        self.silence = silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getListState("chunks", "seq long, text string, at long, finish_reason string")
        self.done = handle.getValueState("done", "first long, last long, open int, timer long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        new = [(r["seq"], r["text"], r["at"], r["finish_reason"]) for r in rows if r["at"] is not None and r["at"] >= watermark]
        if new:
            yield from self._settle(key, new, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._settle(key, [], timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())

    def _settle(self, key, new: list[tuple], watermark: int, fired: int | None = None) -> Iterator[Row]:
        held = self.done.get()
        first, last, n_open, timer = held if held is not None else (None, None, 0, None)
        done = None if first is None else (first, last)
        old = [tuple(r) for r in self.chunks.get()] if n_open else []
        chunks = sorted(old + new, key=lambda r: (r[2], r[0]))
        out, left, timers = [], [], []
        for part in self._parts(chunks):
            first, last = part[0][2], part[-1][2]
            if done and first <= done[1] + self.silence and last >= done[0] - self.silence:
                done = (min(done[0], first), max(done[1], last))
                continue
            row = self._row(part, last + self.silence < watermark)
            if row is None:
                left += part
                timers.append(last + self.silence + 1)
                continue
            out.append(_CLOSED_ROW(key[0], *row))
            if row[-1] == "finish":
                done = (first, last)
        done = done if done and done[1] + self.silence >= watermark else None
        self._keep(old, left, done, timers, None if timer == fired else timer)
        yield from out

    def _parts(self, chunks: list[tuple]) -> Iterator[list[tuple]]:
        part: list[tuple] = []
        for r in chunks:
            if part and r[2] - part[-1][2] > self.silence:
                yield part
                part = []
            part.append(r)
        if part:
            yield part

    def _row(self, part: list[tuple], silent: bool) -> tuple | None:
        texts = {r[0]: r[1] for r in part}
        ends = sorted((r[0], r[3]) for r in part if r[3] is not None)
        if ends and all(k in texts for k in range(ends[0][0] + 1)):
            return "".join(texts[k] for k in range(ends[0][0] + 1)), ends[0][0] + 1, ends[0][1], "finish"
        if silent:
            return "".join(texts[k] for k in sorted(texts)), len(texts), ends[0][1] if ends else None, "timeout"
        return None

    def _keep(self, old: list[tuple], left: list[tuple], done: tuple | None, timers: list[int], timer: int | None) -> None:
        """``timer`` is the one that is set; it is left alone if it ends soon enough."""
        if left and left != old:
            self.chunks.put(left)
        elif old and not left:
            self.chunks.clear()
        if done:
            timers.append(done[1] + self.silence + 1)
        if not timers:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.done.clear()
            return
        if timer is None or min(timers) < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = min(timers)
            self.handle.registerTimer(timer)
        self.done.update((*(done or (None, None)), len(left), timer))

    def close(self) -> None:
        pass


def watch_closing(
    chunks: DataFrame, sink: str, checkpoint: str, time: str, silence: str, late: str, every_seconds: float | None = None
) -> StreamingQuery:
    """Append each completion to a parquet sink when it closes."""
    return start_keyed(to_parquet(close_completions(chunks, time, silence, late), sink, checkpoint), chunks.sparkSession, every_seconds)
