"""Merkle manifest of a dataset, kept as a postorder append log.

Each row is a leaf: the SHA-256 of its columns, each ``-`` for null, else its bytes as ``<length>:<value>``. The
leaves of a group ascend by id, and ``FAN`` neighbours at a time become their hash until one node, the group's root, is left; the
roots of the groups, in the order of the groups, are joined to the root in the same way. Hashes are joined as hex text; they are kept as bytes.

Nodes are written in the order of their completion: a node follows the last of its children at once. A builder takes an
aligned run of ``FAN ** LEVELS`` leaves, so it completes whole subtrees and appends one part of the log; the roots of the builders'
subtrees are the leaves of the next round's log. As every part but the last of a log has the same size, and a node on
level ``v`` follows its last leaf by ``v`` places, the place of any node follows from its level and index alone (``place``), and a
proof takes its siblings from those places. Proofs go down from the top: a part hands the siblings above it to the parts whose
roots are its leaves, so nothing larger than one part meets in a task, whatever share of the rows a group holds.

Defined results: the columns of a leaf are cast to text; a null group is a group of its own, before the others. Null ids come
first. Rows that repeat an id are leaves each, in the order of their hashes. A lone leaf is its group's root, a lone group's root is
the root, and the proof of a node without siblings is the hash of no bytes. Extra columns do not matter; an empty table has no
leaves and no root.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

FAN = 8
#: Levels that one builder completes: its run of leaves has ``FAN ** LEVELS``.
LEVELS = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEX = 64

# --- places in the log ----------------------------------------------------------------------------


def heights(n: int, fan: int = FAN) -> list[int]:
    """Nodes on each level over ``n`` leaves, up to the single one."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // fan))
    return out


@lru_cache(1 << 16)
def place(level: int, index: int, n: int, levels: int, fan: int = FAN) -> int:
    """The place, from 0, of the node in a log of ``n`` leaves whose trees have ``levels`` levels above them.

    Before leaf ``j`` lie the ``j`` leaves before it and every node they complete: ``j // fan ** v`` on level ``v``.
    """
    last = min((index + 1) * fan**level, n) - 1
    return last + sum(last // fan**v for v in range(1, levels + 1)) + level


def size(n: int, levels: int, fan: int = FAN) -> int:
    """The number of nodes in such a log."""
    return sum(-(-n // fan**v) for v in range(levels + 1))


def append_log(leaves: Sequence[str], levels: int, fan: int = FAN) -> list[str]:
    """The nodes over ``leaves`` in the order of their completion. All but the last run of each level are full."""
    log: list[str] = []
    open_: list[list[str]] = [[] for _ in range(levels + 1)]

    def put(level: int, node: str) -> None:
        log.append(node)
        if level < levels:
            open_[level].append(node)
            if len(open_[level]) == fan:
                close(level)

    def close(level: int) -> None:
        node = sha256("".join(open_[level]).encode()).hexdigest()
        open_[level].clear()
        put(level + 1, node)

    for leaf in leaves:
        put(0, leaf)
    for level in range(levels):
        if open_[level]:
            close(level)
    return log


def siblings(log: str, n: int, index: int, levels: int, fan: int = FAN) -> list[tuple[str, str]]:
    """The siblings before and after leaf ``index`` and after each of its ancestors, level by level, from their places in the log."""
    out = []
    for level in range(levels):
        at = index // fan**level
        first, end = at // fan * fan, min(at // fan * fan + fan, -(-n // fan**level))
        nodes = [log[HEX * p : HEX * (p + 1)] for p in (place(level, i, n, levels, fan) for i in range(first, end))]
        out.append(("".join(nodes[: at - first]), "".join(nodes[at - first + 1 :])))
    return out


def fold(node: str, path: Sequence[tuple[str, str]]) -> str:
    """The root over ``node`` with the siblings before and after it, level by level."""
    for before, after in path:
        node = sha256((before + node + after).encode()).hexdigest()
    return node


# --- building ----------------------------------------------------------------------------------------


def leaf_hash(columns: Sequence[Column]) -> Column:
    parts = []
    for x in columns:
        text = x.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def _ranges(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` (``tree`` and more) in ranges of (tree, order), with the number of the range and the place in it."""
    ranges = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    return c.stored(ranges.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.expr("shiftright(at, 33)")), "ranges")


def _indexed(ranges: DataFrame) -> DataFrame:
    """``index``, the place of each row of the ranges in its tree, and ``n``, the size of the tree, from the sizes of the ranges."""
    counts = ranges.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        "tree", "part", (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("held").over(whole).alias("n")
    )
    return ranges.join(shifts, ["tree", "part"]).withColumn("index", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _levels_above(n: int, fan: int, levels: int) -> int:
    """Levels that the builders of a tree with ``n`` leaves complete: all of them if one builder holds the tree."""
    return min(levels, len(heights(n, fan)) - 1)


_OWN = "struct<id:long,changed:binary>"
_PART = f"tree string, part long, n long, top binary, log binary, own array<{_OWN}>"


def _build(fan: int, levels: int):
    """One row per aligned run of the sorted rows: its part of the log, its top, and what belongs to its leaves."""
    run_of = fan**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(key: tuple[str, int, int], leaves: list[str], own: list) -> pa.RecordBatch:
            tree, number, n = key
            log = append_log(leaves, _levels_above(n, fan, levels), fan)
            row = {"tree": tree, "part": number, "n": n, "top": bytes.fromhex(log[-1]), "log": bytes.fromhex("".join(log)), "own": own}
            kind = pa.struct([("id", pa.int64()), ("changed", pa.binary())])
            schema = pa.schema([("tree", pa.string()), ("part", pa.int64()), ("n", pa.int64()), ("top", pa.binary()), ("log", pa.binary()), ("own", pa.list_(kind))])
            return pa.RecordBatch.from_pylist([row], schema)

        held, leaves, own = None, [], []
        for batch in batches:
            for tree, index, n, node, of in zip(*(batch.column(x).to_pylist() for x in ("tree", "index", "n", "node", "own")), strict=True):
                key = (tree, index // run_of, n)
                if key != held:
                    if leaves:
                        yield part(held, leaves, own)
                    held, leaves, own = key, [], []
                leaves.append(node.hex())
                if of is not None:
                    own.append(of)
        if leaves:
            yield part(held, leaves, own)

    return run


def _log_round(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """A round's log: ``nodes`` (``tree, index, n, node, own``) in aligned runs, each in one task."""
    run_of = F.floor(F.col("index") / F.lit(fan**levels))
    dealt = nodes.repartition("tree", run_of).sortWithinPartitions("tree", "index")
    return c.stored(dealt.select("tree", "index", "n", "node", "own").mapInArrow(_build(fan, levels), _PART), "log")


def build_logs(nodes: DataFrame, fan: int = FAN, levels: int = LEVELS) -> list[DataFrame]:
    """The logs of all rounds over ``nodes`` (``tree, index, n, node, own``); each tree ends in the round where one part holds it."""
    rounds = [_log_round(nodes, fan, levels)]
    while True:
        more = rounds[-1].filter(f"n > {fan**levels}")
        if more.isEmpty():
            return rounds
        tops = more.select(
            "tree", F.col("part").alias("index"), F.ceil(F.col("n") / fan**levels).alias("n"), F.col("top").alias("node"), F.lit(None).cast(_OWN).alias("own")
        )
        rounds.append(_log_round(tops, fan, levels))


def roots(rounds: Sequence[DataFrame], fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """``tree, root`` of every tree."""
    out = None
    for log in rounds:
        done = log.filter(f"n <= {fan**levels}").select("tree", F.col("top").alias("root"))
        out = done if out is None else out.unionByName(done)
    return out


# --- proofs -------------------------------------------------------------------------------------------

_PATH = "array<struct<before:string,after:string>>"
_HANDED = f"tree string, index long, above {_PATH}, roots array<string>"


def _pairs(path: list[dict]) -> list[tuple[str, str]]:
    return [(x["before"], x["after"]) for x in path]


def _parts(batches: Iterator[pa.RecordBatch], fan: int, levels: int) -> Iterator[tuple[dict, str, int, int, list[tuple[str, str]]]]:
    """Each part with its log as hex text, its leaves, its levels, and the siblings above it."""
    for batch in batches:
        for k in range(batch.num_rows):
            r = batch.slice(k, 1).to_pylist()[0]
            yield r, r["log"].hex(), min(fan**levels, r["n"] - r["part"] * fan**levels), _levels_above(r["n"], fan, levels), _pairs(r["above"])


def _hand_down(fan: int, levels: int):
    """For every leaf of a part the siblings from it to the top; the leaves are parts of the round before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.struct([("before", pa.string()), ("after", pa.string())])
        for r, log, n, high, above in _parts(batches, fan, levels):
            paths = [[dict(zip(("before", "after"), x, strict=True)) for x in siblings(log, n, i, high, fan) + above] for i in range(n)]
            index = pa.array(np.arange(n) + r["part"] * fan**levels)
            columns = [pa.array([r["tree"]] * n), index, pa.array(paths, pa.list_(pair)), pa.array([r["roots"]] * n, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["tree", "index", "above", "roots"])

    return run


def _handed(parts: DataFrame, fan: int, levels: int) -> DataFrame:
    return parts.select("tree", "part", "n", "log", "above", "roots").mapInArrow(_hand_down(fan, levels), _HANDED)


def hand_down(rounds: Sequence[DataFrame], tops: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """``tree, part, n, log, own, above, roots`` of the first round's parts.

    ``tops``: ``tree, above, roots``, the siblings above each tree's root and the roots on the way.
    """
    held = None
    for log in reversed(rounds):
        parts = log.filter(f"n <= {fan**levels}").join(tops, "tree")
        if held is not None:
            inner = log.filter(f"n > {fan**levels}").join(held.withColumnRenamed("index", "part"), ["tree", "part"])
            parts = parts.unionByName(inner)
        if log is not rounds[0]:
            held = c.stored(_handed(parts, fan, levels), "above")
    return parts


_PROVED = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def _prove(fan: int, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _PROVED.split(", ")]
        for r, log, n, high, above in _parts(batches, fan, levels):
            rows = []
            for i, own in enumerate(r["own"]):
                at = HEX * place(0, i, n, high, fan)
                leaf = log[at : at + HEX]
                path = siblings(log, n, i, high, fan) + above
                proof = sha256("".join(x + y for x, y in path).encode()).hexdigest()
                rows.append((own["id"], leaf, *r["roots"], proof, fold(own["changed"].hex() if own["changed"] else leaf, path)))
            kinds = [pa.int64(), *[pa.string()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    columns: Sequence[str] = COLUMNS,
    changed: dict[str, Column] | None = None,
    where: Column | None = None,
    fan: int = FAN,
    levels: int = LEVELS,
) -> DataFrame:
    """``id_col, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    The rows of ``where`` are folded with the leaf that they have when the columns of ``changed`` are replaced; all others
    with their own leaf. ``verified``: the folded root is the root.
    """
    leaf = leaf_hash([docs[x] for x in columns])
    other = leaf_hash([(changed or {}).get(x, docs[x]) for x in columns])
    wanted = F.lit(False) if where is None or not changed else F.coalesce(where, F.lit(False))
    tree = F.coalesce(F.concat(F.lit("="), docs[group_col].cast("string")), F.lit(""))  # null first, the others in the order of their bytes
    leaves = docs.select(tree.alias("tree"), docs[id_col].cast("long").alias("id"), leaf.alias("node"), F.when(wanted, other).alias("changed"))
    leaves = c.stored(leaves, "leaves")  # the texts are read once; what follows moves hashes
    ranges = _ranges(leaves, ["id", "node"])
    c.discard(leaves)
    rounds = build_logs(_indexed(ranges).withColumn("own", F.struct("id", "changed")), fan, levels)
    c.discard(ranges)

    subroots = roots(rounds, fan, levels).select(F.lit("groups").alias("tree"), F.col("tree").alias("group"), F.col("root").alias("node"))
    numbered = c.stored(_indexed(_ranges(subroots, ["group"])), "subroots")
    no_own = F.lit(None).cast(_OWN)
    upper = build_logs(numbered.select("tree", "index", "n", "node", no_own.alias("own")), fan, levels)
    tops = roots(upper, fan, levels).select("tree", F.array().cast(_PATH).alias("above"), F.array(F.lower(F.hex("root"))).alias("roots"))
    tops = _handed(hand_down(upper, tops, fan, levels), fan, levels).drop("tree")
    tops = tops.join(numbered.select("index", F.col("group").alias("tree"), F.array(F.lower(F.hex("node"))).alias("subroot")), "index")
    tops = c.stored(tops.select("tree", "above", F.concat("subroot", "roots").alias("roots")), "tops")

    parts = hand_down(rounds, tops, fan, levels)
    proved = parts.select("part", "n", "log", "own", "above", "roots").mapInArrow(_prove(fan, levels), _PROVED)
    return proved.withColumnRenamed("id", id_col).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_postorder_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = c.table(spark, sf_dir, "documents")
    tampered = {"text": F.translate(docs["text"], UPPER, LOWER)}
    return manifest(docs, changed=tampered, where=c.fold_of("doc_id", 3) == 0)
