"""Opened and closed findings between successive snapshots of a stream, with the last snapshot of each
subject as keyed state.

Snapshots of a subject that come in one micro-batch are taken in order. One that is not after the subject's
stored snapshot is late: it is dropped, as what it would have changed has been reported. ``stream_expiring`` also closes the findings of
subjects that are not listed any more, and forgets these.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .watch import milliseconds, start_keyed, to_parquet, trigger


def changes(before: set[str], now: list[str]) -> list[tuple[str, str]]:
    new = sorted(set(now) - before)
    return [(r, "opened") for r in new] + [(r, "closed") for r in sorted(before - set(now))]


def _plain(value: Any) -> Any:
    return value.to_pydatetime() if isinstance(value, pd.Timestamp) else value.item() if hasattr(value, "item") else value


def stream_transitions(snapshots: DataFrame, subject: str, order: list[str]) -> DataFrame:
    """``subject, order, rule_id, change`` of ``snapshots(subject, order, rule_ids)``."""
    fields = {f.name: f.dataType.simpleString() for f in snapshots.schema.fields}
    position = ", ".join(f"`{c}` {fields[c]}" for c in order)

    def compare(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, rules = None, set()
        if state.exists:
            *last, held = state.get
            last, rules = tuple(map(_plain, last)), set(held)
        rows = []
        arrived = pd.concat(list(batches)).sort_values(order, kind="stable")
        for values, ids in zip(arrived[order].itertuples(index=False), arrived["rule_ids"], strict=True):
            at = tuple(map(_plain, values))
            if last is not None and at <= last:
                continue
            rows += [(key[0], *values, *change) for change in changes(rules, list(ids))]
            last, rules = at, set(ids)
        state.update((*last, sorted(rules)))
        yield pd.DataFrame(rows, columns=[subject, *order, "rule_id", "change"])

    out = f"`{subject}` {fields[subject]}, {position}, rule_id string, change string"
    return (
        snapshots.select(subject, *order, "rule_ids")
        .groupBy(subject)
        .applyInPandasWithState(compare, out, f"{position}, rule_ids array<string>", "append", GroupStateTimeout.NoTimeout)
    )


def watch_transitions(
    snapshots: DataFrame, sink: str, checkpoint: str, subject: str, order: list[str], every_seconds: float | None = None
) -> StreamingQuery:
    """Append the changes to a parquet sink."""
    return trigger(to_parquet(stream_transitions(snapshots, subject, order), sink, checkpoint), every_seconds).start()


# --- subjects that vanish ------------------------------------------------------------------------------


class _Expiring(StatefulProcessor):
    """The last snapshot of a subject, dropped when none has come for ``absent`` microseconds.

    A subject has one timer, set when it comes and set anew when it ends too early; so a snapshot costs one look at the state and one update.
    """

    def __init__(self, subject: str, position: list[str], absent: int):
        self.subject, self.position, self.absent = subject, position, absent
        self.names = [p.split()[0].strip("`") for p in position]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", f"{', '.join(self.position)}, rule_ids array<string>")

    def _due(self, at: int) -> int:
        return (at + self.absent) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        arrived = [(tuple(r[n] for n in self.names), r["rule_ids"]) for r in rows]
        arrived = [x for x in arrived if x[0][0] is not None and x[0][0] >= watermark]
        if not arrived:
            return
        arrived.sort(key=lambda x: _rank(x[0]))
        held = self.last.get()
        known = held is not None
        last, rules, moved = (tuple(held[:-1]), set(held[-1]), False) if known else (None, set(), False)
        for at, ids in arrived:
            if last is not None and _rank(at) <= _rank(last):
                continue
            if last is not None and at[0] > last[0] + self.absent:
                yield from self._rows(key, last[0] + self.absent, [(r, "closed") for r in sorted(rules)])
                rules = set()
            yield from self._rows(key, at[0], changes(rules, list(ids)))
            last, rules, moved = at, set(ids), True
        if moved:
            self.last.update((*last, sorted(rules)))
        if not known:
            self.handle.registerTimer(self._due(last[0]))

    def _rows(self, key, at: int, changed: list[tuple[str, str]]) -> Iterator[Row]:
        return (Row(**{self.subject: key[0], "at": at, "rule_id": rule, "change": change}) for rule, change in changed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at, *_, held = self.last.get()
        due = self._due(at)
        if due > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(due)
            return
        self.last.clear()
        yield from self._rows(key, at + self.absent, [(r, "closed") for r in sorted(held)])

    def close(self) -> None:
        pass


def _rank(position: tuple) -> tuple:
    """Orders positions, nulls last."""
    return tuple((v is None, 0 if v is None else v) for v in position)


def stream_expiring(snapshots: DataFrame, subject: str, time: str, order: list[str], absent: str, late: str) -> DataFrame:
    """The streaming form of ``containers.transitions_with_expiry``: timers close what the watermark has passed.

    ``order`` begins with ``time``, to which a delay of ``late`` is allowed.
    """
    fields = {f.name: f.dataType.simpleString() for f in snapshots.schema.fields}
    micros = {c for c in order[1:] if fields[c] == "timestamp"}
    position = ["at_micros bigint", *(f"`{c}` {'bigint' if c in micros else fields[c]}" for c in order[1:])]
    rest = [F.unix_micros(c).alias(c) if c in micros else F.col(c) for c in order[1:]]
    rows = snapshots.withWatermark(time, late).select(subject, time, F.unix_micros(time).alias("at_micros"), *rest, "rule_ids")
    processor = _Expiring(subject, position, milliseconds(absent) * 1000)
    out = f"`{subject}` {fields[subject]}, at bigint, rule_id string, change string"
    found = rows.groupBy(subject).transformWithState(processor, out, "append", "eventTime")
    return found.withColumn("at", F.timestamp_micros("at"))


def watch_expiring(
    snapshots: DataFrame, sink: str, checkpoint: str, subject: str, time: str, order: list[str], absent: str, late: str, every_seconds: float | None = None
) -> StreamingQuery:
    """Append the changes to a parquet sink."""
    writer = to_parquet(stream_expiring(snapshots, subject, time, order, absent, late), sink, checkpoint)
    return start_keyed(writer, snapshots.sparkSession, every_seconds)
