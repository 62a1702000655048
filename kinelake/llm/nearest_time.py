"""Matching records by nearest time with x-fast tries.

Both tables are cut into (entity, time block) groups; a block's times are keys
of at most ``BITS`` bits. The key's prefixes of every length go into hash tables
(one trie per entity and block, all tries of a batch in one table per level). A
target's longest present prefix is found by binary search over the length, which
leads to its predecessor and successor; the nearer of both wins if it lies
within the tolerance. Keys only steer the search: distances are exact doubles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.session import change_points, column

#: Length of a time block and of one key step, in seconds; 16 s in microseconds need 24 bits.
BLOCK, STEP, BITS = 16.0, 1e-6, 24
FOUND = "event_a bigint, event_b bigint, record_id bigint, distance double"
MIX = np.uint64(0x9E3779B97F4A7C15)


class HashTable:
    """A set of 64-bit keys with a value each: open addressing, linear probing, whole arrays at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        self.mask, self.shift = np.uint64(size - 1), np.uint64(64 - size.bit_length() + 1)
        self.slot = np.full(size, -1, np.int64)
        self.keys, self.values = keys.astype(np.uint64), values
        todo, at = np.arange(len(keys)), self._home(self.keys)
        while len(todo):
            free = self.slot[at] < 0
            self.slot[at[free]] = todo[free]  # of several for one place the last stays
            lost = self.slot[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & (size - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * MIX) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key in ``values``, -1 where it is absent."""
        keys = keys.astype(np.uint64)
        out, todo, at = np.full(len(keys), -1, np.int64), np.arange(len(keys)), self._home(keys)
        size = len(self.slot)
        while len(todo):
            found = self.slot[at]
            hit = (found >= 0) & (self.keys[found] == keys[todo])
            out[todo[hit]] = found[hit]
            on = (found >= 0) & ~hit
            todo, at = todo[on], (at[on] + 1) & (size - 1)
        return out


class XFastTrie:
    """Predecessor search over (entity, key) pairs sorted by both, distinct."""

    def __init__(self, entity: np.ndarray, key: np.ndarray, bits: int = BITS):
        self.bits, self.n = bits, len(key)
        self.full = (entity.astype(np.int64) << (bits + 1)) | key
        self.levels: list[HashTable] = []
        for length in range(bits + 1):
            prefix = self.full >> (bits - length)
            first = change_points(prefix)
            last = np.append(first[1:], self.n) - 1
            # each node knows the range of leaves below it (the descendant pointers)
            self.levels.append(HashTable(prefix[first], np.stack([first, last], 1)))

    def predecessor(self, entity: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The place of the greatest key <= ``key`` of the entity, -1 where there is none."""
        full = (entity.astype(np.int64) << (self.bits + 1)) | key
        low, high = np.zeros(len(full), np.int64), np.full(len(full), self.bits + 1)  # present at low, absent at high
        node = self.levels[0].get(full >> self.bits)
        known = node >= 0
        lo_v, hi_v = self._range(0, node)
        while True:
            open_ = known & (high - low > 1)
            if not open_.any():
                break
            mid = (low + high) // 2
            for length in np.unique(mid[open_]):
                at = np.flatnonzero(open_ & (mid == length))
                got = self.levels[length].get(full[at] >> (self.bits - length))
                hit = got >= 0
                low[at[hit]], high[at[~hit]] = length, length
                a, b = self._range(length, got[hit])
                lo_v[at[hit]], hi_v[at[hit]] = a, b
        # at the longest present prefix the next bit has no child: all leaves below lie on one side of the key
        out = np.full(len(full), -1, np.int64)
        whole = known & (low == self.bits)
        out[whole] = lo_v[whole]
        part = known & (low < self.bits)
        bit = (full >> np.maximum(self.bits - low - 1, 0)) & 1
        out[part] = np.where(bit[part] == 1, hi_v[part], lo_v[part] - 1)
        ok = out >= 0
        ok[ok] = (self.full[out[ok]] >> (self.bits + 1)) == entity[ok]
        return np.where(ok, out, -1)

    def _range(self, length: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = self.levels[length].values
        if not len(v):
            return np.full(len(node), -1, np.int64), np.full(len(node), -1, np.int64)
        got = v[np.maximum(node, 0)]
        return got[:, 0].copy(), got[:, 1].copy()


def match_nearest(records: DataFrame, events: DataFrame, tolerance: float, block: float = BLOCK) -> DataFrame:
    """Pair each event with the record of its entity nearest in time.

    ``records``: entity_1, entity_2 (strings or numbers, together the entity),
    record_id, record_time. ``events``: the same entity columns, event_a, event_b
    (bigint, the event's key), target, low, high: only records with
    ``low <= record_time < high`` count (null: no bound).
    Returned: event_a, event_b, record_id, distance; distance <= tolerance, on
    ties the smaller record_id. Null entities and times that are not finite
    match nothing; repeated records and events count once; records of equal time
    are one with the smallest id; extra columns are ignored; empty tables give none.

    Work is cut into (entity, block of time) groups; a record also stands in the
    next block if it lies within the tolerance of its border. Records of a group
    are at most one per representable time of the block; events stream past them.
    """
    if block / STEP >= 2**BITS or tolerance >= block / 2:
        raise ValueError("a block must fit the key's bits and exceed twice the tolerance")
    inf = float("inf")
    ent = [F.xxhash64("entity_1", "entity_2").alias("h1"), F.xxhash64(F.lit("#"), "entity_2", "entity_1").alias("h2")]  # 128 bits
    both = F.col("entity_1").isNotNull() & F.col("entity_2").isNotNull()
    slack = tolerance * 1.001 + 2 * STEP
    rec = (
        records.where(both & F.col("record_time").isNotNull() & ~F.isnan("record_time") & (F.abs("record_time") < inf) & F.col("record_id").isNotNull())
        .select(*ent, (F.col("record_time") + F.lit(0.0)).alias("time"), "record_id")
        .groupBy("h1", "h2", "time")
        .agg(F.min("record_id").alias("a"))
    )
    t = F.col("time")
    rec = rec.select("h1", "h2", F.explode(F.array_distinct(F.array(F.floor((t - slack) / block), F.floor(t / block), F.floor((t + slack) / block)))).alias("block"), F.lit(0).cast("tinyint").alias("tag"), "time", "a")
    ev = events.where(both & F.col("target").isNotNull() & ~F.isnan("target") & (F.abs("target") < inf)).select(
        *ent, F.floor(F.col("target") / block).alias("block"), F.lit(1).cast("tinyint").alias("tag"), F.col("target").alias("time"), F.col("event_a").alias("a"), F.col("event_b").alias("b"), F.coalesce("low", F.lit(-inf)).alias("low"), F.coalesce("high", F.lit(inf)).alias("high")
    )
    # records come first in their group, in order of time
    keyed = rec.unionByName(ev, allowMissingColumns=True).repartition("h1", "h2", "block").sortWithinPartitions("h1", "h2", "block", "tag", "time")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        pending: list[pa.RecordBatch] = []
        rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, pending, rows
            tbl = pa.concat_tables([*([held] if held is not None else []), pa.Table.from_batches(pending)])
            found, held = _match_table(tbl, tolerance, block)
            pending, rows = [], 0
            if found is not None:
                yield found

        for batch in batches:
            if batch.num_rows:
                pending.append(batch)
                rows += batch.num_rows
                if rows >= 100_000:
                    yield from flush()
        if pending:
            yield from flush()

    return keyed.mapInArrow(run, FOUND)


def _match_table(tbl: pa.Table, tolerance: float, block: float) -> tuple[pa.RecordBatch | None, pa.Table]:
    """Matches of the events in ``tbl``, and the records of its last group, which may have more events."""
    h1, h2, blk, tag = (column(tbl, c) for c in ("h1", "h2", "block", "tag"))
    starts = change_points(h1, h2, blk)
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(h1))))
    is_rec = tag == 0
    keep = tbl.filter(pa.array(is_rec & (group == group[-1])))
    at = np.flatnonzero(~is_rec)
    ri = np.flatnonzero(is_rec)
    if not len(at) or not len(ri):
        return None, keep
    time = column(tbl, "time")
    ident = column(tbl, "a")
    rt, rg = time[ri], group[ri]
    begin = (blk[starts] * block) - block / 4  # halo records lie a little outside their block
    scale = 2**BITS / (block * 1.5)

    def key(t: np.ndarray, g: np.ndarray) -> np.ndarray:
        return np.clip(np.floor((t - begin[g]) * scale), 0, 2**BITS - 1).astype(np.int64)

    rk = key(rt, rg)
    first = change_points(rg, rk)  # leaves; times within one key share a leaf
    leaf_end = np.append(first[1:], len(rt)) - 1
    trie = XFastTrie(rg[first], rk[first])
    g = group[at]
    target, low, high = time[at], column(tbl, "low")[at], column(tbl, "high")[at]

    def last_not_after(x: np.ndarray) -> np.ndarray:
        """The place of the last record at or before x, from the trie's leaf on."""
        leaf = trie.predecessor(g, key(x, g))
        pos = np.where(leaf >= 0, leaf_end[np.maximum(leaf, 0)], -1)
        while True:  # only within the leaf of x itself
            over = (pos >= 0) & (rg[np.maximum(pos, 0)] == g) & (rt[np.maximum(pos, 0)] > x)
            if not over.any():
                break
            pos[over] -= 1
        return np.where((pos >= 0) & (rg[np.maximum(pos, 0)] == g), pos, -1)

    start_of = np.searchsorted(rg, g)  # first record of the group
    with np.errstate(all="ignore"):
        upper = np.minimum(target, np.nextafter(high, -np.inf))
        p = last_not_after(upper)
        s = last_not_after(np.nextafter(np.maximum(target, low), -np.inf))
    s = np.where(s >= 0, s + 1, start_of)
    s_ok = (s < len(rt)) & (rg[np.minimum(s, len(rt) - 1)] == g)
    s = np.minimum(s, len(rt) - 1)
    rid = ident[ri]
    pt, st = rt[np.maximum(p, 0)], rt[s]
    dp = np.where((p >= 0) & (pt >= low) & (pt < high), np.abs(target - pt), np.inf)
    ds = np.where(s_ok & (st >= low) & (st < high), np.abs(target - st), np.inf)
    idp, ids = rid[np.maximum(p, 0)], rid[s]
    use_s = (ds < dp) | ((ds == dp) & (ids < idp))
    d, record = np.where(use_s, ds, dp), np.where(use_s, ids, idp)
    ok = d <= tolerance
    ea, eb = ident[at], tbl.column("b").to_numpy()[at].astype(np.int64)
    out = pa.RecordBatch.from_arrays([pa.array(ea[ok]), pa.array(eb[ok]), pa.array(record[ok]), pa.array(d[ok])], names=["event_a", "event_b", "record_id", "distance"])
    return out, keep


def frames_for_steps(steps: DataFrame, episodes: DataFrame, frames: DataFrame, tolerance: float = 0.040) -> DataFrame:
    """The nearest frame of each step's video: episode_key, frame_index, frame_id."""
    media = episodes.groupBy("episode_key").agg(F.min(F.struct("source_id", "video", "video_offset", "video_end")).alias("e")).select("episode_key", "e.*")
    media = media.where(F.col("video").isNotNull() & F.col("source_id").isNotNull()).withColumn("video_offset", F.coalesce("video_offset", F.lit(0.0)))
    once = steps.select("episode_key", "frame_index", "step_time").where(F.col("step_time").isNotNull() & ~F.isnan("step_time")).dropDuplicates(["episode_key", "frame_index", "step_time"])
    events = once.join(media, "episode_key").select(
        F.col("source_id").alias("entity_1"), F.col("video").alias("entity_2"), F.col("episode_key").alias("event_a"), F.col("frame_index").alias("event_b"), (F.col("step_time") + F.col("video_offset")).alias("target"), F.col("video_offset").alias("low"), F.col("video_end").alias("high")
    )
    records = frames.select(F.col("source_id").alias("entity_1"), F.col("video").alias("entity_2"), F.col("frame_id").alias("record_id"), F.col("pts").alias("record_time"))
    found = match_nearest(records, events, tolerance)
    return found.select(F.col("event_a").alias("episode_key"), F.col("event_b").alias("frame_index"), F.col("record_id").alias("frame_id"))
