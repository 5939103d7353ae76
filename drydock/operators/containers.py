"""Container audit over inspect documents, and the change between snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import fallback
from .rows import unfold
from .skew import previous

# Policies and drivers that count as unset.
NO_RESTART = ("", "no")
UNBOUNDED_LOGS = ("", "json-file")


def inspect_findings(doc: Column) -> Column:
    state, host = doc["State"], doc["HostConfig"]
    running = F.coalesce(state["Running"], F.lit(False))
    ports = doc["NetworkSettings"]["Ports"]
    found = rules.fired(
        {
            "container_stopped": ~running,
            "container_unhealthy": running
            & state["Health"].isNotNull()
            & (F.coalesce(state["Health"]["Status"], F.lit("")) != "healthy"),
            "container_root": fallback(doc["Config"]["User"], "root") == "root",
            "container_no_restart": F.coalesce(host["RestartPolicy"]["Name"], F.lit("")).isin(*NO_RESTART),
            "container_privileged": F.coalesce(host["Privileged"], F.lit(False)),
            "container_no_memory_limit": F.coalesce(host["Memory"], F.lit(0)) == 0,
            "container_log_driver": host["LogConfig"]["Type"].isin(*UNBOUNDED_LOGS),
            "container_port_unbound": F.coalesce(F.exists(F.map_values(ports), lambda p: p.isNull()), F.lit(False)),
        }
    )
    return F.when(doc.isNull(), F.array(rules.finding("container_inspect_failed"))).otherwise(
        rules.or_ok(found, "container_ok")
    )


def container_findings(containers: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``keys, rule_id, severity``; a container without a finding gets one ``container_ok`` row."""
    keys = keys or ["container_id"]
    return unfold(containers, keys, inspect_findings(F.col("doc")), "_f").select(*keys, "_f.*")


def rule_sets(containers: DataFrame, keys: list[str]) -> DataFrame:
    """One row per snapshot with its rule ids as a sorted array; ``ok`` counts as no finding."""
    ids = F.transform(inspect_findings(F.col("doc")), lambda f: f["rule_id"])
    return containers.select(*keys, F.array_sort(F.filter(ids, lambda r: r != "container_ok")).alias("rule_ids"))


def transitions(snapshots: DataFrame, subject: str, order: list[str]) -> DataFrame:
    """``subject, order, rule_id, change``: what opened or closed since the snapshot before.

    ``snapshots`` carries ``rule_ids``. The first snapshot of a subject opens all its findings.
    """
    compared = previous(snapshots, [subject], order, "rule_ids", "_before")
    return _changes(compared, [subject, *order], "_before")


def transitions_with_expiry(snapshots: DataFrame, subject: str, time: str, order: list[str], absent: str, late: str = "0 seconds") -> DataFrame:
    """``subject, at, rule_id, change``: what opened or closed, also because the subject was not listed any more.

    A subject without a snapshot for longer than ``absent`` has gone: its findings close at that time after the last one, and
    its next snapshot opens all its findings. What the latest time of all snapshots, less ``late``, has not passed stays open.
    ``order`` begins with ``time``.
    """
    kept = F.struct(*order, "rule_ids")
    held = snapshots.withColumn("_kept", kept)
    compared = previous(held, [subject], order, "_kept", "_last")
    gone_at = F.col(f"_last.{time}") + F.expr(f"interval {absent}")
    gone = F.col(time) > gone_at
    before = F.coalesce(F.when(~F.coalesce(gone, F.lit(False)), F.col("_last.rule_ids")), F.array().cast("array<string>"))
    seen = _changes(compared.withColumn("_before", before), [subject, time], "_before").withColumnRenamed(time, "at")
    left = compared.filter(gone).select(subject, gone_at.alias("at"), F.col("_last.rule_ids").alias("rule_ids"))
    latest = held.agg((F.max(time) - F.expr(f"interval {late}")).alias("_latest"))
    ends = held.groupBy(subject).agg(F.max("_kept").alias("_last")).crossJoin(latest).filter(F.col("_latest") > gone_at)
    left = left.unionByName(ends.select(subject, gone_at.alias("at"), F.col("_last.rule_ids").alias("rule_ids")))
    closed = unfold(left, [subject, "at"], F.col("rule_ids"), "rule_id").withColumn("change", F.lit("closed"))
    return seen.unionByName(closed)


def _changes(df: DataFrame, keys: list[str], before: str) -> DataFrame:
    old = F.coalesce(F.col(before), F.array().cast("array<string>"))
    opened = F.transform(
        F.array_except("rule_ids", old), lambda r: F.struct(r.alias("rule_id"), F.lit("opened").alias("change"))
    )
    closed = F.transform(
        F.array_except(old, "rule_ids"), lambda r: F.struct(r.alias("rule_id"), F.lit("closed").alias("change"))
    )
    return unfold(df, keys, F.concat(opened, closed), "_c").select(*keys, "_c.*")
