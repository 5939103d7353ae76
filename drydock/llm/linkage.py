"""Links between similar items: buckets, exact confirmation, and components by distributed union-find.

Items are numbered, and compared only if they share a bucket. Bucket keys travel as arrays with the items and a sketch of
their sets; where they meet they are sorted in ranges, one at a time. A task sorts a quarter of a million keys before it sends them, and
of more than ``SMALL`` items that share a bucket there it sends only the smallest on, so of a bucket of any size each task sends a few.

The items of small buckets meet as pairs, all of them. Two sketches agree in fewer than ``least_agreement`` bits less than once in a million
for sets that are just similar enough; such pairs go at once. Each member of a larger bucket first meets the smallest item
that its task knows, and these meet each other. What is then left to settle are large buckets that hold several components; there, members
outside the largest component meet the members of other components, up to ``BLOCK_PAIRS`` of them in blocks of bounded bytes inside tasks. Blocks hold bitmaps of the
sets, which bound from below in how many elements two sets differ, so no similar pair is missed; few pairs are left, and only these are compared with their sets. Buckets of very
many pairs that are nearly similar are compared in blocks of sets. The members
of larger buckets are put in new ones, by the rarest elements of their sets, so many that two similar sets must share one, and
settled in the same way, so unlike members of a large bucket cost no more than their elements. No pair that shares a bucket and lies in two
components stays unchecked.

Tables between the steps are written to the shared folder and removed when the next one stands.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, give_back, mix, stored

#: Most pairs for each item of two blocks that are compared as rows, and most pairs of a bucket that meet in blocks.
FEW_PAIRS, BLOCK_PAIRS = 1, 1 << 24
#: Items and words of a block of bitmaps, and of one of sets.
BLOCK, BLOCK_WORDS, SETS, SET_WORDS = 256, 1 << 15, 64, 1 << 20
#: Least and most 64-bit words of the bitmap of a set, and words of pairs of bitmaps that one step compares.
MAP_WORDS, STEP_MAPS = (4, 1 << 18), 1 << 15
#: Bits of a membership bitmap for each key, and its most 64-bit words: the bound of what is broadcast.
BITS_PER_KEY, BITMAP_WORDS = 16, 1 << 20
#: Bucket keys that a task sorts at a time, and the ranges of keys that a task takes one after the other.
GATHER, RANGES = 1 << 18, 4
#: Items of a bucket that all meet as pairs.
SMALL = 16
#: Bits of a sketch, and how often, at most, a sketch hides a pair that is just similar enough.
SKETCH, HIDDEN = 64, 1e-6


Batches = Iterator[pa.RecordBatch]


def maybe_in(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be in ``keys``: all that are, and one in 16 of the others, more beyond some 4 million keys.

    A bitmap sized by the number of keys, of at most ``BITMAP_WORDS`` rows, is broadcast; nothing else moves.
    """
    words = min(BITMAP_WORDS, keys.count() * BITS_PER_KEY // 64 + 1)
    bit = F.pmod(F.xxhash64(key), F.lit(words * 64))
    masks = (
        keys.select(bit.alias("_b"))
        .select((F.col("_b") / 64).cast("long").alias("_w"), F.expr("shiftleft(1L, cast(_b % 64 as int))").alias("_m"))
        .groupBy("_w")
        .agg(F.bit_or("_m").alias("_m"))
    )
    marked = df.withColumn("_b", bit)
    hit = marked.join(F.broadcast(masks), (F.col("_b") / 64).cast("long") == F.col("_w"))
    return hit.filter(F.expr("(shiftright(_m, cast(_b % 64 as int)) & 1) = 1")).drop("_b", "_w", "_m")


def bitmap(keys: DataFrame, key: str) -> Broadcast:
    """The bits of ``maybe_in`` for tasks that look up 64-bit keys with ``in_bitmap``: 64-bit words, sent to each worker once."""
    words = min(BITMAP_WORDS, keys.count() * BITS_PER_KEY // 64 + 1)

    def marked(batches: Batches) -> Batches:
        found = np.zeros(words, np.uint64)
        for batch in batches:
            at = _bit_of(batch.column("key").to_numpy(), words)
            np.bitwise_or.at(found, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at].view(np.int64))], ["w", "m"])

    masks = keys.select(F.col(key).alias("key")).mapInArrow(marked, "w long, m long").groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    found = np.zeros(words, np.uint64)
    found[masks.column("w").to_numpy()] = masks.column("m").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(found)


def _bit_of(keys: np.ndarray, words: int) -> np.ndarray:
    return (mix(keys.view(np.uint64)) % np.uint64(words * 64)).view(np.int64)


def in_bitmap(keys: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which keys may be known: all that are, and one in 16 of the others, more beyond some 4 million keys."""
    at = _bit_of(keys, len(found))
    return (found[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def _forest(batches: Batches) -> Batches:
    """The edges of a task as stars: each id with the smallest one that these edges link it with."""
    a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*[(np.zeros(0, np.int64),) * 2, *((y.column("a").to_numpy(), y.column("b").to_numpy()) for y in batches)]))
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        on = low < high
        a, b = a[on], b[on]
        np.minimum.at(root, high[on], low[on])
        while len(np.flatnonzero(root[root] != root)):
            root = root[root]
    on = root < np.arange(len(ids))
    yield pa.RecordBatch.from_arrays([pa.array(ids[on]), pa.array(ids[root[on]])], ["a", "b"])


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first())


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every id on an edge ``(a, b)``; the component is its smallest id. The result is stored.

    Each task first makes stars of its edges, then large-star and small-star steps in turn join those of all tasks, until nothing changes. Each step is
    a partial minimum per id and a join, so an id with many edges is split like any skewed join key.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = stored(edges.mapInArrow(_forest, "a long, b long"), "edges")
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(low, "a")
        small = met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, edges = edges, stored(small.unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "edges")
        discard(last)
        state = _state(edges)
        if state == before:
            break
        before = state
    roots = edges.select(F.col("b").alias("id")).distinct()
    of = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    out = stored(of.unionByName(roots.select("id", F.col("id").alias("component"))), "components")
    discard(edges)
    return out


# --- buckets ---------------------------------------------------------------------------------------


def least_agreement(percent: int, bits: int = SKETCH, hidden: float = HIDDEN) -> int:
    """Bits in which the sketches of two sets that share ``percent`` of their union agree, but for a chance of ``hidden``.

    A bit comes from a MinHash coordinate: it agrees with the share in common, and else in half of all cases.
    """
    agree, total = (1 + percent / 100) / 2, 0.0
    for k in range(bits + 1):
        total += comb(bits, k) * agree**k * (1 - agree) ** (bits - k)
        if total > hidden:
            return k
    return bits


def sketch_bits(signature: np.ndarray) -> np.ndarray:
    """A bit of each of the first ``SKETCH`` MinHash coordinates, as one 64-bit word an item."""
    bits = (signature[:, :SKETCH] * np.uint32(0x9E3779B1)) >> np.uint32(31)
    return np.packbits(bits.astype(np.uint8), axis=1).view(np.uint64).ravel()


def _sorted_runs(keys: np.ndarray, ids: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (key, id) by key, then id, with what belongs to them, and where a key begins."""
    order = np.argsort(keys)
    keys = keys[order]
    shared = np.flatnonzero((np.append(keys[1:] == keys[:-1], False)) | (np.append(False, keys[1:] == keys[:-1])))
    if len(shared):
        order[shared] = order[shared][np.lexsort((ids[order[shared]], keys[shared]))]
    ids = ids[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    keep = first.copy()
    keep[1:] |= ids[1:] != ids[:-1]
    return (keys[keep], ids[keep], *[x[order[keep]] for x in more], first[keep])


def _agree(a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    return np.bitwise_count(~(a ^ b)) >= least


def _close_pairs(ids: np.ndarray, sketches: np.ndarray, run: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of items of a run whose sketches agree; runs follow each other and have ``SMALL`` items at most."""
    a, b = [], []
    for d in range(1, SMALL):
        at = np.flatnonzero(run[d:] == run[:-d])
        if not len(at):
            break
        at = at[_agree(sketches[at], sketches[at + d], least)]
        a.append(ids[at])
        b.append(ids[at + d])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


_DEALT = "part int, range int, keys binary, ids binary, sketches binary, large binary, leads binary"
_MET = "bucket long, id long, lead long, near boolean"


def _deal(parts: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = parts * RANGES
        limits = np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)
        turn = TaskContext.get().partitionId()

        def send(keys: np.ndarray, ids: np.ndarray, sketches: np.ndarray) -> pa.RecordBatch:
            nonlocal turn
            keys, ids, sketches, first = _sorted_runs(keys, ids, sketches)
            head, run_of = np.flatnonzero(first), np.cumsum(first) - 1
            large = (np.diff(np.append(head, len(keys))) > SMALL)[run_of]
            lead = head[run_of[large]]
            known = keys[large], ids[large], _agree(sketches[large], sketches[lead], least).astype(np.uint64), ids[lead]
            on = ~large | first
            keys, ids, sketches, large = keys[on], ids[on], sketches[on], large[on]
            at = np.concatenate([[0], np.searchsorted(keys, limits), [len(keys)]]).tolist()
            rows = [
                (k // RANGES, k % RANGES, *[x[a:b].tobytes() for x in (keys, ids, sketches, large)], None)
                for k, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True))
                if b > a
            ]
            if len(lead):  # members with their lead: they need not meet, so the tasks take them in turn
                turn += 1
                rows.append((turn % parts, RANGES, *[x.tobytes() for x in known[:3]], None, known[3].tobytes()))
            names = [x.split()[0] for x in _DEALT.split(", ")]
            kinds = [pa.int32() if x in ("part", "range") else pa.binary() for x in names]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        held, n = [], 0
        for batch in batches:
            bucket, ids, sketches = (batch.column(x) for x in ("bucket", "id", "sketch"))
            ids, sketches = ids.to_numpy(), sketches.to_numpy().view(np.uint64)
            if pa.types.is_list(bucket.type):
                of = np.repeat(np.arange(len(ids)), np.diff(bucket.offsets.to_numpy()))
                ids, sketches, bucket = ids[of], sketches[of], bucket.flatten()
            if not len(ids):
                continue
            held.append((bucket.to_numpy().view(np.uint64), ids, sketches))
            n += len(ids)
            if n >= GATHER:
                yield send(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held, n = [], 0
        if held:
            yield send(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _members(keys: np.ndarray | None, ids: np.ndarray, leads: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
    bucket = pa.nulls(len(ids), pa.int64()) if keys is None else pa.array(keys.view(np.int64))
    return pa.RecordBatch.from_arrays([bucket, pa.array(ids), pa.array(leads), pa.array(near)], ["bucket", "id", "lead", "near"])


def _meet(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], -1

        def met() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            keys, ids, sketches, large, first = _sorted_runs(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            head, run_of = np.flatnonzero(first), np.cumsum(first) - 1
            size = np.diff(np.append(head, len(keys)))
            star = (size > SMALL) | (np.logical_or.reduceat(large, head) & (size > 1))
            small = (~star & (size > 1))[run_of]
            a, b = _close_pairs(ids[small], sketches[small], run_of[small], least)
            yield _members(None, b, a, np.ones(len(a), bool))
            star = star[run_of]
            lead = head[run_of[star]]
            yield _members(keys[star], ids[star], ids[lead], _agree(sketches[star], sketches[lead], least))

        for batch in batches:
            part, turn, *parts = (batch.column(x) for x in batch.schema.names)
            with_lead = parts[-1].is_valid().to_numpy(False)
            for k, number in enumerate((part.to_numpy() * (RANGES + 1) + turn.to_numpy()).tolist()):
                keys, ids, sketches = (np.frombuffer(x[k].as_buffer(), t) for x, t in zip(parts, (np.uint64, np.int64, np.uint64)))
                if number != now:
                    yield from met()
                    now = number
                if with_lead[k]:
                    yield _members(keys, ids, np.frombuffer(parts[4][k].as_buffer(), np.int64), sketches.astype(bool))
                else:
                    held.append((keys, ids, sketches, np.frombuffer(parts[3][k].as_buffer(), bool)))
        yield from met()
        give_back()

    return run


def crowded(banded: DataFrame, percent: int = 0, make: Callable[[Batches], Batches] | None = None) -> DataFrame:
    """``bucket, id, lead, near`` of the items that share a bucket, from ``bucket`` (one or an array) and ``id``, both long. The result is stored.

    Pairs of items of a small bucket have no bucket; those with sketches (``sketch``, if there are any) too far apart for ``percent`` are left out. Of
    a large one all members are listed with a lead, and whether their sketch is near the lead's; leads lead to one another, so
    all members but the smallest are listed with a smaller one. ``make`` gives these columns from the batches of ``banded``, in the
    same Python worker.
    """
    parts = int(banded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    has = make is not None or "sketch" in banded.columns
    deal = _deal(parts, least := least_agreement(percent) if has else 0)
    if make:
        dealt = banded.mapInArrow(lambda batches: deal(make(batches)), _DEALT)
    else:
        sketch = "sketch" if has else F.lit(0).cast("long").alias("sketch")
        dealt = banded.select("bucket", "id", sketch).mapInArrow(deal, _DEALT)
    met = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "range").mapInArrow(_meet(least), _MET)
    return stored(met, "buckets")


def _labelled(items: DataFrame, comps: DataFrame) -> DataFrame:
    return items.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _stars(met: DataFrame) -> DataFrame:
    """The pairs of small buckets, and every member of a large one with the leads that it knows."""
    return met.filter("id <> lead and near").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()


@dataclass
class Compare:
    """How items are compared.

    ``pairs``: from distinct pairs ``(a, b)`` to those that are similar. ``items``: ``id, v``, what is compared.
    ``sets``: from a list of values to their sets, each a sorted array of 64-bit words; sets whose shared part is
    ``percent`` of their union or more are similar. ``tables`` are the stored ones that go when all is done.
    """

    pairs: Callable[[DataFrame], DataFrame]
    items: DataFrame
    sets: Callable[[pa.Array], list[np.ndarray]]
    percent: int
    tables: Sequence[DataFrame] = ()


#: Distinct words that one step compares as bits.
PRODUCT_WORDS = 1 << 15


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return x[new]


def similar_blocks(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether each set of ``left`` is similar to each of ``right``.

    The sets become rows of bits over the words that both sides have; the bits that two rows
    share are counted, exactly.
    """
    flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right)]
    both = np.sort(np.concatenate([_distinct(x) for x in flat]))
    words = both[1:][both[1:] == both[:-1]]
    shared = np.zeros((len(left), len(right)))
    rows = [np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (left, right)]
    at = [np.searchsorted(words, x) for x in flat]
    known = [(k < len(words)) & (words[np.minimum(k, max(len(words) - 1, 0))] == x) if len(words) else np.zeros(len(x), bool) for k, x in zip(at, flat, strict=True)]
    for start in range(0, len(words), PRODUCT_WORDS):
        width = min(PRODUCT_WORDS, len(words) - start)
        side = []
        for x, row, k, ok in zip((left, right), rows, at, known, strict=True):
            ok = ok & (k >= start) & (k < start + width)
            bits = np.zeros((len(x), -(-width // 64) * 64), bool)
            bits[row[ok], k[ok] - start] = True
            side.append(np.packbits(bits, axis=1).view(np.uint64))
        for i, own in enumerate(side[0]):
            shared[i] += np.bitwise_count(own & side[1]).sum(axis=1)
    sizes = [np.array([len(y) for y in x], float) for x in (left, right)]
    union = sizes[0][:, None] + sizes[1][None, :] - shared
    return (100 * shared >= percent * union) & (shared > 0)


def _open(members: DataFrame, comps: DataFrame) -> DataFrame:
    """``bucket, id, component, total, n_inside, inside, pairs`` of the buckets with several components; ``inside``: in their largest. Stored.

    ``members`` may repeat. An item lies in several buckets, so it is labelled once, beside their list: as long as it has bands, or rare elements.
    """
    own = members.groupBy("id").agg(F.collect_set("bucket").alias("buckets"))
    held = stored(_labelled(own, comps).select(F.explode("buckets").alias("bucket"), "id", "component"), "labels")
    sizes = held.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    total = sizes.groupBy("bucket").agg(F.sum("n").alias("total"), F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("kinds"))
    mixed = held.join(total.filter("kinds > 1"), "bucket")
    inside = (F.col("component") == F.col("most.component")).alias("inside")
    pairs = ((F.col("total") - F.col("most.n")) * F.col("total")).alias("pairs")
    open_ = stored(mixed.select("bucket", "id", "component", "total", F.col("most.n").alias("n_inside"), inside, pairs), "open")
    discard(held)
    return open_


def parity_maps(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The size of each set, the 64-bit words of its bitmap, and all bitmaps one after the other.

    A bitmap has a bit for each value of a hash, set if an odd number of elements have it; it has twice as many bits as the set has
    elements, or more. Each element that only one of two sets has turns one bit, so their bitmaps differ in no more bits
    than the sets in elements. Halves laid over each other (exclusive or) are the bitmap of half the width.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    words = np.full(len(sets), MAP_WORDS[0], np.int64)
    while len(few := np.flatnonzero((words * 32 < sizes) & (words < MAP_WORDS[1]))):
        words[few] *= 2
    ends = np.cumsum(words)
    maps = np.zeros(ends[-1] if len(sets) else 0, np.uint64)
    for k in range(0, len(sets), BLOCK):
        x = np.concatenate(sets[k : k + BLOCK]).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(36)
        width, first = (np.repeat(y[k : k + BLOCK], sizes[k : k + BLOCK]) for y in (words, ends - words))
        at = first + ((x >> np.uint64(6)).view(np.int64) & (width - 1))
        np.bitwise_xor.at(maps, at, np.uint64(1) << (x & np.uint64(63)))
    return sizes, words, maps


def near_maps(left: np.ndarray, right: np.ndarray, sizes: Sequence[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``left`` and ``right`` of all pairs of sets that may share ``percent`` of their union, and in how many elements, at least, these differ.

    Rows of ``left`` and ``right`` are bitmaps of one width on each side. No similar pair is missed: sets that share so much
    differ in ``(100 - percent) / (100 + percent)`` of their elements at most.
    """
    maps = [left, right]
    for k in range(2):
        while maps[k].shape[1] > maps[1 - k].shape[1]:
            half = maps[k].shape[1] // 2
            maps[k] = maps[k][:, :half] ^ maps[k][:, half:]
    a, b = (np.ascontiguousarray(x.T) for x in maps)
    step = max(1, STEP_MAPS // max(1, b.size))
    found = []
    for k in range(0, a.shape[1], step):
        x, y = sizes[0][k : k + step, None], sizes[1][None, :]
        apart = np.add.reduce(np.bitwise_count(a[:, k : k + step, None] ^ b[:, None, :]), axis=0, dtype=np.int64)
        np.maximum(apart, np.abs(x - y), out=apart)
        i, j = np.nonzero(apart * (100 + percent) <= (x + y) * (100 - percent))
        found.append((i + k, j, apart[i, j]))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *x]) for x in zip(*found, strict=True)) if found else (none, none, none)


def _maps(sets: Callable[[pa.Array], list[np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                part = batch.slice(k, BLOCK)
                sizes, words, maps = parity_maps(sets(part.column("v")))
                ends = np.concatenate([[0], np.cumsum(8 * words)]).astype(np.int32)
                bits = pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(maps.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sizes), pa.array(words), bits], ["id", "n", "words", "bits"])
        give_back()

    return run


def _near_in_blocks(percent: int, most: int):
    """The pairs of two blocks that may be similar; if they are more than ``most`` for each item, a row of nulls instead."""

    def side(of: pa.StructArray):
        bits = of.field("bits")
        ends = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset : bits.offset + len(bits) + 1]
        maps = np.frombuffer(bits.buffers()[2], np.uint8)[ends[0] : ends[-1]].copy().view(np.uint64).reshape(len(of), -1)
        return (maps, *(of.field(x).to_numpy() for x in ("n", "id", "component")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, lows, highs = [], [], []
            for k in range(batch.num_rows):
                (ma, na, ida, ca), (mb, nb, idb, cb) = (side(batch.column(x)[k].values) for x in ("left", "right"))
                i, j, _ = near_maps(ma, mb, (na, nb), percent)
                on = ca[i] != cb[j]
                a, b = ida[i[on]], idb[j[on]]
                if not len(a):
                    continue
                many = len(a) > most * (len(ida) + len(idb))
                buckets.append(np.full(1 if many else len(a), batch.column("bucket")[k].as_py()))
                lows.append(pa.nulls(1, pa.int64()) if many else pa.array(np.minimum(a, b)))
                highs.append(pa.nulls(1, pa.int64()) if many else pa.array(np.maximum(a, b)))
            if buckets:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(buckets)), pa.concat_arrays(lows), pa.concat_arrays(highs)], ["bucket", "a", "b"])
        give_back()

    return run


def _links_in_blocks(open_: DataFrame, compare: Compare) -> DataFrame:
    """The links between the components of each bucket. The result is stored.

    Blocks hold bitmaps, not sets; the pairs that these leave are compared by ``compare.pairs``. Buckets of which they leave very many are compared in blocks of sets.
    """
    percent = compare.percent
    ids = stored(open_.select("id").distinct(), "open-ids")
    maps = maybe_in(compare.items, "id", ids).join(ids, "id", "left_semi").select("id", "v")
    maps = maps.mapInArrow(_maps(compare.sets), "id long, n long, words long, bits binary")
    # Sets of which one has a bitmap much wider than the other differ too much in size.
    placed = stored(open_.select("bucket", "id", "component", "inside").join(maps, "id"), "maps")
    own = ["bucket", "inside", "words"]
    sums = placed.groupBy(own).agg(F.ceil(F.count("*") / F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_WORDS) / F.col("words"))))).alias("blocks"))
    dealt = placed.join(sums, own).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    blocks = stored(dealt.groupBy(*own, "block").agg(F.collect_list(F.struct("id", "component", "n", "bits")).alias("of")), "blocks")
    discard(ids, placed)
    left = blocks.filter("not inside").select("bucket", F.col("words").alias("lw"), F.col("block").alias("lb"), F.col("of").alias("left"))
    right = blocks.select("bucket", "inside", F.col("words").alias("rw"), F.col("block").alias("rb"), F.col("of").alias("right"))
    fit = F.greatest("lw", "rw") * percent <= 200 * F.least("lw", "rw")
    met = left.join(right, "bucket").filter(fit & F.expr("inside or lw < rw or (lw = rw and lb <= rb)")).select("bucket", "left", "right")
    near = stored(met.mapInArrow(_near_in_blocks(percent, FEW_PAIRS), "bucket long, a long, b long"), "near")
    discard(blocks)
    links = compare.pairs(near.filter("a is not null").select("a", "b").distinct()).select("a", "b")
    crowds = near.filter("a is null").select("bucket").distinct()
    if not crowds.isEmpty():
        links = links.unionByName(_links_in_sets(open_.join(crowds, "bucket", "left_semi"), compare))
    links = stored(links, "links")
    discard(near)
    return links


def _met_in_blocks(sets: Callable[[pa.Array], list[np.ndarray]], percent: int):
    """Links between two blocks: of those that join the same two components one is enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                left, right = batch.column("left")[k].values, batch.column("right")[k].values
                names, place = np.unique(
                    [str(x) for side in (left, right) for x in side.field("component").to_pylist()], return_inverse=True
                )
                ca, cb = place[: len(left)], place[len(left) :]
                hits = similar_blocks(sets(left.field("v")), sets(right.field("v")), percent) & (ca[:, None] != cb[None, :])
                i, j = np.nonzero(hits)
                if len(i):
                    _, first = np.unique(np.minimum(ca[i], cb[j]) * len(names) + np.maximum(ca[i], cb[j]), return_index=True)
                    ia, ib = left.field("id").take(pa.array(i[first])), right.field("id").take(pa.array(j[first]))
                    yield pa.RecordBatch.from_arrays([ia, ib], ["a", "b"])
        give_back()

    return run


def _links_in_sets(open_: DataFrame, compare: Compare) -> DataFrame:
    with_sets = stored(open_.join(compare.items, "id"), "with-sets")
    words = F.size("v") if compare.items.schema["v"].dataType.typeName() == "array" else F.octet_length("v")
    sums = with_sets.groupBy("bucket", "inside").agg(F.greatest(F.ceil(F.count("*") / SETS), F.ceil(F.sum(words) / SET_WORDS)).alias("blocks"))
    placed = with_sets.join(sums, ["bucket", "inside"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    item = F.struct("id", "component", "v")
    blocks = stored(placed.groupBy("bucket", "inside", "block").agg(F.collect_list(item).alias("of")), "set-blocks")
    discard(with_sets)
    left = blocks.filter("not inside").select("bucket", F.col("block").alias("lb"), F.col("of").alias("left"))
    right = blocks.select("bucket", "inside", F.col("block").alias("rb"), F.col("of").alias("right"))
    met = left.join(right, "bucket").filter("inside or lb <= rb").select("left", "right")
    return met.mapInArrow(_met_in_blocks(compare.sets, compare.percent), "a long, b long").distinct()


def _elements(sets: Callable[[pa.Array], list[np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                (x,) = sets(batch.column("v").slice(k, 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), batch.column("id")[k].as_py())), pa.array(x.view(np.int64))], ["id", "bucket"])

    return run


def _by_rare_elements(ids: DataFrame, compare: Compare) -> DataFrame:
    """``bucket, id, lead`` of the items by the rarest elements of their sets.

    Of two sets that share ``percent`` of their union, the first ``n - ceil(n * percent / 100) + 1`` elements in one order
    have one in common. The order is that of the number of sets that hold an element, so unlike sets share few.
    """
    held = compare.items.join(ids, "id", "left_semi").select("id", "v")
    elements = stored(held.mapInArrow(_elements(compare.sets), "id long, bucket long"), "elements")
    counts = elements.groupBy("bucket").agg(F.count("*").alias("n"))
    sizes = elements.groupBy("id").agg(F.count("*").alias("size"))
    ranked = elements.join(counts, "bucket").withColumn("rank", F.expr("row_number() over (partition by id order by n, bucket)"))
    first = F.col("rank") <= F.col("size") - F.ceil(F.col("size") * F.lit(compare.percent) / 100) + 1
    met = crowded(ranked.join(sizes, "id").filter(first & (F.col("n") > 1)).select("bucket", "id"))
    discard(elements)
    return met


def _merged(comps: DataFrame | None, found: DataFrame) -> DataFrame:
    """The components with more links: only the components that these join are united anew."""
    if comps is None:
        return components(found)
    for end in ("a", "b"):
        of = comps.select(F.col("id").alias(end), F.col("component").alias("c"))
        found = found.join(of, end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    named = stored(found.filter("a <> b").distinct(), "joins")
    if named.isEmpty():
        discard(named)
        return comps
    joined = components(named)
    to = joined.select(F.col("id").alias("component"), F.col("component").alias("c"))
    moved = comps.join(to, "component", "left").select("id", F.coalesce("c", "component").alias("component"))
    out = stored(moved.unionByName(joined.join(comps.select("id"), "id", "left_anti")), "components")
    discard(named, joined, comps)
    return out


def linked(
    members: DataFrame, prepare: Callable[[DataFrame], Compare], percent: int = 0, make: Callable[[Batches], Batches] | None = None
) -> DataFrame:
    """``id, component`` of the ids that are linked with another one. The result is stored.

    ``members``: ``bucket`` (a long or an array of them), ``id`` (long) and, if there is one, ``sketch`` (long, see ``sketch_bits``), whose pairs
    are similar at ``percent``; or what ``make`` makes these from. ``prepare`` takes the ids that may ever be compared (column ``id``).
    """
    met = crowded(members, percent, make)
    ids = met.select("id").unionByName(met.select(F.col("lead").alias("id"))).distinct()
    ids = stored(ids, "ids")
    compare, comps = prepare(ids), None
    discard(ids)
    for last in (False, True):
        comps = _merged(comps, compare.pairs(_stars(met)))
        open_ = _open(met.filter("bucket is not null"), comps)
        discard(met)
        large = F.lit(False) if last else F.col("pairs") > BLOCK_PAIRS
        if not open_.isEmpty():
            comps = _merged(comps, _links_in_blocks(open_.filter(~large), compare))
        rest = open_.filter(large).select("id").distinct()
        again = not rest.isEmpty()
        if again:
            met = _by_rare_elements(rest, compare)
        discard(open_)
        if not again:
            break
    discard(*compare.tables)
    return comps
