"""Deduplicating new batches against all history.

Each episode gets a sketch: five quantiles of every channel, which removing or
changing a fifth of the frames moves only a little. Sketches live in navigable
small-world graphs, one shard or more per embodiment and history segment; a batch
forms a new segment, and scheduled compaction merges segments as a binary counter
carries. An episode asks the graphs of all segments for everything within the
bounds of its quantiles, and what they return is compared frame by frame.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.llm.families import connected_components
from kinelake.llm.small_world import SmallWorld
from kinelake.session import change_points, column, cut_lineage, padded, scratch_path, vectors, whole_groups

#: Share of the longer episode's frames that must reappear, and the tolerance as a share of the joint limit.
SHARE, TOLERANCE = 0.8, 0.001
#: Frames that one task sketches at once: a longer episode is summed up in pieces of this many, by so many order statistics each.
PIECE, SUMMARY = 8192, 512
#: Nodes of one shard at most (a larger segment is cut by length and level into several), and queries of a shard that one task handles.
SHARD, ASKED = 20_000, 50_000
#: Share of the nodes within bounds that a graph must find for a sample of so many of its nodes; the beam is widened until it does.
RECALL, SAMPLE = 0.995, 128
#: The number of a batch that the sources do not list.
NO_BATCH = 2**31 - 1
LEVELS = np.array([0.1, 0.3, 0.5, 0.7, 0.9])
#: Fixed codes for values that only agree with themselves.
CODES = {"null": 1e300, "nan": 2e300, "inf": 3e300}
#: Quantiles are cut at this many joint limits; it is also what a channel that is not there has.
CUT = 2.0
SKETCH = "episode_key bigint, frames bigint, digest binary, sketch array<float>"
SUMMED = "episode_key bigint, piece bigint, frames bigint, digest binary, points array<float>, sketch array<float>"
INDEX = "shard bigint, nodes int, beam int, recall double, keys binary, lengths binary, sketches binary, near binary, far binary"
CANDIDATE = "a bigint, b bigint, distance double"
LINK = "a bigint, b bigint, share double"


def _parts(tbl: pa.Table) -> list[np.ndarray]:
    """State and action; null, NaN and the infinities as codes far off every number."""
    parts = []
    for name in ("state", "action"):
        flat, off = vectors(tbl, name)
        col = tbl.column(name).combine_chunks()
        col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
        missing = col.flatten().is_null().to_numpy(zero_copy_only=False)
        v = np.where(missing, CODES["null"], np.where(np.isnan(flat), CODES["nan"], np.where(np.isinf(flat), np.sign(flat) * CODES["inf"], flat)))
        m = padded(v, off)
        parts.append(np.where(np.isnan(m), CODES["null"], m))
    return parts


def _coded(tbl: pa.Table) -> np.ndarray:
    """State and action side by side."""
    return np.concatenate(_parts(tbl), 1)


def _interleaved(tbl: pa.Table, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State and action channels in turns, and how many of these columns each episode has (up to its last value, one at least).

    So a channel's column does not depend on the widths of other episodes.
    """
    parts = _parts(tbl)
    out = np.full((tbl.num_rows, 2 * max(1, *(v.shape[1] for v in parts))), CODES["null"])
    for k, v in enumerate(parts):
        out[:, k : 2 * v.shape[1] : 2] = v
    there = np.logical_or.reduceat(out != CODES["null"], starts, axis=0)
    return out, np.maximum((there * np.arange(1, out.shape[1] + 1)).max(1), 1)


def _distinct_frames(tbl: pa.Table, keys: list[str]) -> pa.Table:
    cols = [column(tbl, k) for k in [*keys, "frame_index"]]
    keep = np.zeros(len(cols[0]), bool)
    keep[change_points(*cols)] = True
    return tbl if keep.all() else tbl.filter(pa.array(keep))


def episode_sketches(steps: DataFrame, limits: DataFrame) -> DataFrame:
    """Per episode: frames, digest of all frames in order, sketch over all frames.

    ``limits``: episode_key, joint_limit. Quantiles are in units of the joint limit
    and cut at twice it. Episodes without a joint limit or frames give no row. An
    episode beyond ``PIECE`` frames is spread over tasks piece by piece, and its
    quantiles come from the pieces' order statistics (a rank is off by 1/``SUMMARY``
    at most, which the bounds' slack covers).
    """
    rows = steps.where(F.col("episode_key").isNotNull() & F.col("frame_index").isNotNull())
    piece = F.floor(F.col("frame_index") / PIECE)
    spans = rows.groupBy("episode_key").agg((F.max(piece) == F.min(piece)).alias("single"))
    info = spans.join(limits.where(F.col("joint_limit") > 0), "episode_key")
    known = rows.select("episode_key", "frame_index", "state", "action", piece.alias("piece")).join(info, "episode_key")
    keyed = known.repartition("episode_key", "piece").sortWithinPartitions("episode_key", "piece", "frame_index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tbl in whole_groups(batches, ["episode_key", "piece"]):
            tbl = _distinct_frames(tbl, ["episode_key", "piece"])
            single = column(tbl, "single").astype(bool)
            if single.any():
                got = _sketch_table(tbl if single.all() else tbl.filter(pa.array(single)))
                none = pa.nulls(got.num_rows, pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([got.column(0), pa.array(np.zeros(got.num_rows, np.int64)), got.column(1), got.column(2), none, got.column(3)], names=["episode_key", "piece", "frames", "digest", "points", "sketch"])
            if not single.all():
                yield _summary_table(tbl.filter(pa.array(~single)))

    summed = cut_lineage(keyed.mapInArrow(run, SUMMED))
    short = summed.where("sketch is not null").select("episode_key", "frames", "digest", "sketch")
    long = summed.where("sketch is null").select("episode_key", "piece", "frames", "digest", "points").repartition("episode_key").sortWithinPartitions("episode_key", "piece")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tbl in whole_groups(batches, ["episode_key"], 1):
            yield _merged(tbl)

    return short.unionByName(long.mapInArrow(merge, SKETCH))


def _scaled(x: np.ndarray, tbl: pa.Table) -> np.ndarray:
    return np.clip(x / column(tbl, "joint_limit")[:, None], -CUT, CUT)


def _digests(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, widths: np.ndarray) -> list[bytes]:
    return [hashlib.blake2b(int(w).to_bytes(8, "little") + np.ascontiguousarray(x[a:b, :w]).tobytes(), digest_size=16).digest() for a, b, w in zip(starts, ends, widths, strict=True)]


def _sketch_table(tbl: pa.Table) -> pa.RecordBatch:
    """Sketches of whole episodes, rows sorted by episode and frame."""
    key = column(tbl, "episode_key")
    starts = change_points(key)
    x, widths = _interleaved(tbl, starts)
    ends = np.append(starts[1:], len(key))
    group = np.repeat(np.arange(len(starts)), ends - starts)
    scaled = _scaled(x, tbl)
    at = starts[:, None] + np.minimum((LEVELS[None, :] * (ends - starts)[:, None]).astype(np.int64), (ends - starts)[:, None] - 1)
    sketch = np.empty((len(starts), x.shape[1] * len(LEVELS)), np.float32)
    for c in range(x.shape[1]):
        order = np.lexsort((scaled[:, c], group))
        sketch[:, c * len(LEVELS) : (c + 1) * len(LEVELS)] = scaled[order, c][at]
    own = np.repeat(np.arange(x.shape[1]), len(LEVELS))[None, :] < widths[:, None]
    offsets = pa.array(np.concatenate([[0], np.cumsum(widths * len(LEVELS))]).astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(key[starts]), pa.array(ends - starts), pa.array(_digests(x, starts, ends, widths), pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(sketch[own]))], names=["episode_key", "frames", "digest", "sketch"])


def _summary_table(tbl: pa.Table) -> pa.RecordBatch:
    """Pieces of long episodes: frames, digest, and per channel ``SUMMARY`` order statistics."""
    key, piece = column(tbl, "episode_key"), column(tbl, "piece")
    starts = change_points(key, piece)
    ends = np.append(starts[1:], len(key))
    x, widths = _interleaved(tbl, starts)
    scaled, points = _scaled(x, tbl), []
    for a, b, w in zip(starts, ends, widths, strict=True):
        at = ((np.arange(SUMMARY) + 0.5) / SUMMARY * (b - a)).astype(np.int64)
        points.append(np.sort(scaled[a:b, :w], 0)[at].T.ravel().astype(np.float32))
    none = pa.nulls(len(starts), pa.list_(pa.float32()))
    return pa.RecordBatch.from_arrays([pa.array(key[starts]), pa.array(piece[starts]), pa.array(ends - starts), pa.array(_digests(x, starts, ends, widths), pa.binary()), pa.array(points, pa.list_(pa.float32())), none], names=["episode_key", "piece", "frames", "digest", "points", "sketch"])


def _merged(tbl: pa.Table) -> pa.RecordBatch:
    """Sketches of long episodes from their pieces' summaries, weighted by frames."""
    key, frames = column(tbl, "episode_key"), column(tbl, "frames")
    starts = np.append(change_points(key), len(key))
    digests, points, out = tbl.column("digest").to_pylist(), tbl.column("points").to_pylist(), []
    for s, e in zip(starts[:-1], starts[1:], strict=True):
        width = max(len(p) for p in points[s:e]) // SUMMARY
        v = np.full((e - s, width, SUMMARY), CUT, np.float32)
        for i, p in enumerate(points[s:e]):
            v[i, : len(p) // SUMMARY] = np.asarray(p, np.float32).reshape(-1, SUMMARY)
        v = v.transpose(1, 0, 2).reshape(width, -1)
        weight = np.repeat(frames[s:e] / SUMMARY, SUMMARY)
        order = np.argsort(v, axis=1, kind="stable")
        up_to = np.cumsum(weight[order], 1)
        at = np.minimum((up_to[:, None, :] <= LEVELS[None, :, None] * up_to[:, -1:, None]).sum(2), v.shape[1] - 1)
        sketch = np.take_along_axis(np.take_along_axis(v, order, 1), at, 1).ravel()
        out.append((int(key[s]), int(frames[s:e].sum()), hashlib.blake2b(b"".join(digests[s:e]), digest_size=16).digest(), sketch.tolist()))
    cols = list(zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.list_(pa.float32()))], names=["episode_key", "frames", "digest", "sketch"])


# --- bounds ---------------------------------------------------------------------------------


def _sketches(tbl: pa.Table) -> np.ndarray:
    """Sketches as a matrix; a channel that a sketch lacks is null in every frame."""
    flat, off = vectors(tbl, "sketch")
    m = padded(flat, off)
    return np.where(np.isnan(m), CUT, m).astype(np.float32)


def _widened(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1])), constant_values=CUT)


def _slack(x: np.ndarray) -> np.ndarray:
    """Per channel, what order statistics of few frames may be off by."""
    return 3 * TOLERANCE + 0.1 * (x[:, :, 4] - x[:, :, 0])


def _channels(x: np.ndarray) -> np.ndarray:
    return x.reshape(len(x), x.shape[1] // len(LEVELS), len(LEVELS))


def _node(x: np.ndarray, frames: np.ndarray) -> np.ndarray:
    """Sketches as graph nodes: the inner quantiles, and the length on a scale where 80 % is one tenth."""
    inner = _channels(x)[:, :, 1:4].reshape(len(x), -1)
    return np.column_stack([inner, 0.1 * np.log(frames) / np.log(1 / SHARE)]).astype(np.float32)


def _box(x: np.ndarray, frames: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest node that a partner may be: inner quantiles between the query's outer ones, a length of 80 % or more."""
    c = _channels(x)
    slack = _slack(c)[:, :, None]
    length = (0.1 * np.log(frames) / np.log(1 / SHARE))[:, None]
    lo = np.concatenate([(c[:, :, :3] - slack).reshape(len(x), -1), length - 0.10001], 1)
    hi = np.concatenate([(c[:, :, 2:] + slack).reshape(len(x), -1), length + 0.10001], 1)
    return lo.astype(np.float32) - np.float32(1e-6), hi.astype(np.float32) + np.float32(1e-6)


def within_bounds(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether sketches may belong to episodes that share 80 % of their frames.

    Their distribution functions then differ by at most 0.2, so each inner quantile
    lies between the other's quantiles two tenths lower and higher.
    """
    a, b = _channels(x), _channels(y)
    ok = np.ones(len(x), bool)
    for p, q in ((a, b), (b, a)):
        slack = _slack(q)
        for k in range(1, 4):
            ok &= ((p[:, :, k] >= q[:, :, k - 1] - slack) & (p[:, :, k] <= q[:, :, k + 1] + slack)).all(1)
    return ok


# --- the index ------------------------------------------------------------------------------


def _middle(which: int, sign: int) -> Column:
    """A quantile of every channel, moved by the slack (sign -1 or 1), averaged: what routes a query to shards."""
    n = len(LEVELS)
    starts = F.sequence(F.lit(0), F.size("sketch") - n, F.lit(n))
    moved = F.transform(starts, lambda i: F.get("sketch", i + which) + sign * (3 * TOLERANCE + 0.1 * (F.get("sketch", i + n - 1) - F.get("sketch", i))))
    return (F.aggregate(moved, F.lit(0.0), lambda a, v: a + v) / (F.size("sketch") / n)).cast("double")


def compacted(points: DataFrame, batch_ranks: int, most_nodes: int = SHARD) -> DataFrame:
    """Give points their segment and shard after ``batch_ranks`` batches: the binary decomposition of the history.

    Batches merge as a binary counter carries, so a history of n batches has at
    most log2(n) + 1 segments per embodiment, and each point moves log2(n) times.
    ``points`` has ``batch_rank`` (0-based). A segment above ``most_nodes`` is cut
    into bands of like length and each band by level into shards.
    """
    edges, at = [], 0
    for k in reversed(range(max(batch_ranks.bit_length(), 1))):
        if batch_ranks >> k & 1:
            at += 1 << k
            edges.append(at)
    segment = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        segment = F.when(F.col("batch_rank") < edges[i], F.lit(i)).otherwise(segment)
    return sharded(points.withColumn("segment", segment.cast("bigint")), most_nodes)


def sharded(points: DataFrame, most_nodes: int = SHARD) -> DataFrame:
    """``points`` (with ``segment``) with band, level and shard."""
    group = ["embodiment", "segment"]
    sizes = points.groupBy(*group).agg((F.count(F.lit(1)) > most_nodes).alias("cut"))
    band = F.when(F.col("cut"), F.floor(F.log("frames") / np.log(1 / SHARE))).otherwise(-1).cast("bigint")
    placed = points.join(sizes, group).withColumn("band", band).withColumn("level", F.when(F.col("cut"), _middle(2, 0)).otherwise(0.0))
    places = [i / 1024 for i in range(1, 1024)]
    cuts = placed.where("cut").groupBy(*group, "band").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("level", places, 20000).alias("at"))
    step = F.greatest(F.floor(1024 * most_nodes / F.col("n")), F.lit(1)).cast("int")
    cuts = cuts.select(*group, "band", F.filter("at", lambda v, i: (i + 1) % step == 0).alias("at"))
    placed = placed.join(cuts, [*group, "band"], "left").withColumn("part", F.coalesce(F.size(F.filter("at", lambda v: v < F.col("level"))), F.lit(0))).drop("at", "cut")
    full = placed.groupBy(*group, "band", "part").agg(F.ceil(F.count(F.lit(1)) / (2 * most_nodes)).alias("subs"))  # many equal levels
    placed = placed.join(full, [*group, "band", "part"])
    return placed.withColumn("shard", F.xxhash64(*group, "band", "part", F.pmod(F.xxhash64("episode_key"), "subs"))).drop("part", "subs")


def places_of(shards: DataFrame) -> DataFrame:
    """One row per shard with the extremes that route queries to it."""
    return shards.groupBy("embodiment", "band", "shard").agg(F.min("level").alias("least"), F.max("level").alias("most"), F.min("frames").alias("short"), F.max("frames").alias("long"))


def graph_index(shards: DataFrame) -> DataFrame:
    """One row per shard: a small-world graph over its sketches, its beam tuned against exhaustive search (``recall`` is what it reached)."""
    keyed = shards.select("shard", "episode_key", "frames", "sketch").repartition("shard").sortWithinPartitions("shard", "episode_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tbl in whole_groups(batches, ["shard"], 1):
            shard = column(tbl, "shard")
            starts = np.append(change_points(shard), len(shard))
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                part = tbl.slice(s, e - s)
                x, frames = _sketches(part), column(part, "frames")
                order = np.random.default_rng(5).permutation(e - s)
                x, frames = x[order], frames[order]
                graph = SmallWorld(_node(x, frames))
                pick = np.arange(0, e - s, max(1, (e - s) // SAMPLE))
                graph.tune_inside(*_box(x[pick], frames[pick]), RECALL)
                cells = [v.tobytes() for v in (column(part, "episode_key")[order].astype(np.int64), frames.astype(np.int64), x, graph.near, graph.far)]
                yield pa.RecordBatch.from_arrays([pa.array([shard[s]], pa.int64()), pa.array([e - s], pa.int32()), pa.array([graph.beam], pa.int32()), pa.array([graph.recall], pa.float64()), *(pa.array([c], pa.binary()) for c in cells)], names=[c.split()[0] for c in INDEX.split(", ")])

    return keyed.mapInArrow(run, INDEX)


def _loaded(batch: pa.RecordBatch, i: int) -> dict:
    read = lambda name, kind: np.frombuffer(batch.column(batch.schema.get_field_index(name))[i].as_py(), kind)
    n, beam = (int(batch.column(batch.schema.get_field_index(c))[i].as_py()) for c in ("nodes", "beam"))
    return {"key": read("keys", np.int64), "frames": read("lengths", np.int64), "sketch": read("sketches", np.float32).reshape(n, -1), "near": read("near", np.int32).reshape(n, -1), "far": read("far", np.int32).reshape(n, -1), "beam": beam}


def routed(points: DataFrame, places: DataFrame) -> DataFrame:
    """``points`` with every shard of their embodiment that may hold a partner; shards whose extremes rule it out are left out."""
    band = F.floor(F.log("frames") / np.log(1 / SHARE)).cast("bigint")
    asks = points.select("episode_key", "embodiment", "frames", "sketch", F.explode(F.array(F.lit(-1).cast("bigint"), band - 1, band, band + 1)).alias("band"), _middle(1, -1).alias("low"), _middle(3, 1).alias("high"))
    near = (F.col("band") == -1) | ((F.col("most") >= F.col("low") - 1e-6) & (F.col("least") <= F.col("high") + 1e-6))
    like = (F.col("long") >= SHARE * F.col("frames") - 1e-9) & (F.col("frames") >= SHARE * F.col("short") - 1e-9)
    return asks.join(places, ["embodiment", "band"]).where(near & like).select("shard", "episode_key", "frames", "sketch")


def asked(index: DataFrame, asks: DataFrame) -> DataFrame:
    """Candidates (a, b, distance): everything within bounds that the asked shards' graphs return.

    Each task reads a shard's graph and streams queries past it; a shard with many
    queries is read by several tasks.
    """
    slices = asks.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / ASKED).alias("slices"))
    nodes = index.join(slices, "shard").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1))).withColumn("tag", F.lit(0)).drop("slices")
    queries = asks.join(slices, "shard").select("shard", F.pmod(F.xxhash64("episode_key"), "slices").alias("slice"), F.lit(1).alias("tag"), "episode_key", "frames", "sketch")
    both = nodes.unionByName(queries, allowMissingColumns=True)
    keyed = both.repartition("shard", "slice").sortWithinPartitions("shard", "slice", "tag", "episode_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("shard", "slice", "tag")]
            starts = np.append(change_points(*cols), batch.num_rows)
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if cols[2][s] == 0:
                    shard = _loaded(batch, int(s))
                else:
                    yield from _answers(shard, pa.Table.from_batches([batch.slice(s, e - s)]))

    return keyed.mapInArrow(run, CANDIDATE)


def _answers(shard: dict, tbl: pa.Table) -> Iterator[pa.RecordBatch]:
    q, key, frames = _sketches(tbl), column(tbl, "episode_key"), column(tbl, "frames").astype(np.int64)
    width = max(q.shape[1], shard["sketch"].shape[1])
    q = _widened(q, width)
    if "graph" not in shard or shard["sketch"].shape[1] < width:
        shard["sketch"] = _widened(shard["sketch"], width)
        shard["graph"] = SmallWorld.stored(_node(shard["sketch"], shard["frames"]), shard["near"], shard["far"], shard["beam"])
    for at in range(0, len(q), 4096):
        part, n = q[at : at + 4096], frames[at : at + 4096]
        i, j = shard["graph"].inside(*_box(part, n))
        fa, fb = n[i], shard["frames"][j]
        ok = (key[at + i] != shard["key"][j]) & (np.minimum(fa, fb) >= SHARE * np.maximum(fa, fb) - 1e-9)
        i, j = i[ok], j[ok]
        for lo in range(0, len(i), 100_000):
            r, c = i[lo : lo + 100_000], j[lo : lo + 100_000]
            ok = within_bounds(part[r], shard["sketch"][c])
            r, c = r[ok], c[ok]
            if len(r):
                x, y = key[at + r], shard["key"][c]
                d = ((part[r] - shard["sketch"][c]).astype(np.float64) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(d)], names=["a", "b", "distance"])


def candidates(points: DataFrame, most_batches: int) -> DataFrame:
    """Pairs (a, b, distance) within the quantiles' bounds, found by the graphs of the compacted history.

    ``points``: episode_key, embodiment, batch_rank, frames, sketch. Every point asks
    every segment, so each pair is asked for from both sides.
    """
    shards = cut_lineage(compacted(points, most_batches))
    return asked(cut_lineage(graph_index(shards)), routed(points, places_of(shards)))


def batch_against_history(new_points: DataFrame, shards: DataFrame) -> DataFrame:
    """Candidate pairs of a new batch with a history given as points with their shard (see ``compacted``)."""
    shards = cut_lineage(shards)
    return asked(cut_lineage(graph_index(shards)), routed(new_points, places_of(shards)))


class HistoryIndex:
    """The stored history: per segment the points, the graphs and the shards' extremes, as tables in a shared folder.

    ``add`` writes a batch as a new segment and compacts: while the last two segments
    hold equally many batches they are merged and their graphs built anew, so n
    batches keep at most log2(n) + 1 segments and each point moves log2(n) times.
    ``candidates`` reads the graphs that a query is routed to, never earlier frames.
    """

    def __init__(self, spark: SparkSession, folder: str, segments: list[tuple[int, int]] | None = None):
        self.spark, self.folder, self.segments = spark, folder, list(segments or [])

    @classmethod
    def opened(cls, spark: SparkSession, folder: str) -> HistoryIndex:
        """The index that ``folder`` holds, with the segments of its last ``add``."""
        last = spark.read.text(f"{folder}/state").orderBy(F.desc(F.get_json_object("value", "$.batches").cast("bigint"))).head()
        return cls(spark, folder, [tuple(s) for s in json.loads(last["value"])["segments"]])

    def _read(self, part: str) -> DataFrame:
        return self.spark.read.parquet(*(f"{self.folder}/{part}-{a}-{b}" for a, b in self.segments))

    def add(self, points: DataFrame) -> None:
        """``points``: episode_key, embodiment, frames, sketch of one batch."""
        at = self.segments[-1][1] if self.segments else 0
        merged, first = [points.select("episode_key", "embodiment", "frames", "sketch")], at
        while self.segments and self.segments[-1][1] - self.segments[-1][0] == at + 1 - first:
            a, b = self.segments.pop()
            merged.append(self.spark.read.parquet(f"{self.folder}/points-{a}-{b}").select("episode_key", "embodiment", "frames", "sketch"))
            first = a
        every = merged[0]
        for m in merged[1:]:
            every = every.unionByName(m)
        name = f"{first}-{at + 1}"
        sharded(every.withColumn("segment", F.lit(first).cast("bigint"))).write.parquet(f"{self.folder}/points-{name}")
        kept = self.spark.read.parquet(f"{self.folder}/points-{name}")
        graph_index(kept).write.parquet(f"{self.folder}/graphs-{name}")
        places_of(kept).coalesce(1).write.parquet(f"{self.folder}/places-{name}")
        self.segments.append((first, at + 1))
        told = json.dumps({"batches": at + 1, "segments": self.segments})
        self.spark.createDataFrame([(told,)], "value string").coalesce(1).write.mode("append").text(f"{self.folder}/state")

    def candidates(self, points: DataFrame) -> DataFrame:
        return asked(self._read("graphs"), routed(points, self._read("places")))


def new_batch_repeats(index: HistoryIndex, points: DataFrame, steps: DataFrame, limits: DataFrame) -> DataFrame:
    """Links (a, b, share) of a new batch's episodes with the stored history and with one another, compared frame by frame.

    The history's frames are read only for the candidates' episodes. ``points`` are
    the batch's sketches, ``steps`` and ``limits`` cover both sides.
    """
    own = HistoryIndex(index.spark, f"{index.folder}/incoming-{index.segments[-1][1] if index.segments else 0}")
    own.add(points)
    pairs = own.candidates(points)
    if index.segments:
        pairs = pairs.unionByName(index.candidates(points))
    return compare_pairs(cut_lineage(pairs.select("a", "b").distinct()), steps, limits)


def replayed_batch(steps: DataFrame, episodes: DataFrame, sources: DataFrame) -> DataFrame:
    """The links (episode_key_a, episode_key_b) that the last third of the deliveries makes when it arrives as one batch.

    The first two thirds are stored before, in two batches that compaction merges.
    A batch without a number (missing in ``sources``) is among the new ones.
    """
    spark = steps.sparkSession
    listed = cut_lineage(deliveries(episodes, sources))
    limits = listed.select("episode_key", "joint_limit")
    points = cut_lineage(episode_sketches(steps, limits).join(listed, "episode_key"))
    last = listed.where(F.col("batch_no") < NO_BATCH).agg(F.max("batch_no")).head()[0] or 0
    index = HistoryIndex(spark, scratch_path(spark, "history"))
    for low, high in ((None, last // 3), (last // 3, last * 2 // 3)):
        index.add(points.where(F.col("batch_no") <= high) if low is None else points.where((F.col("batch_no") > low) & (F.col("batch_no") <= high)))
    new = points.where(F.col("batch_no") > last * 2 // 3)
    links = new_batch_repeats(index, new, steps, limits)
    return links.select(F.col("a").alias("episode_key_a"), F.col("b").alias("episode_key_b"))


# --- exact comparison -----------------------------------------------------------------------


def common_frames(x: np.ndarray, y: np.ndarray, tolerance: float, least: int = 0) -> int:
    """Frames of ``x`` that reappear in ``y`` in the same order (longest common subsequence within the tolerance).

    Bit-parallel over the frames of ``y``: memory is linear in the frames. With
    ``least`` only frames that a subsequence of that length could pair are compared
    (it leaves out at most len - least on either side), and the result is exact
    where it reaches ``least``; else it is some number below.
    """
    width = max(x.shape[1], y.shape[1])
    x, y = (np.pad(v, ((0, 0), (0, width - v.shape[1])), constant_values=CODES["null"]) for v in (x, y))
    n, m = len(x), len(y)
    if min(n, m) < least:
        return 0
    back, ahead = m - least, n - least
    inner = np.where(np.abs(y) < 1e299, y, np.nan)
    with np.errstate(all="ignore"):
        spread = np.nan_to_num(np.nanmax(inner, 0, initial=-np.inf) - np.nanmin(inner, 0, initial=np.inf), nan=0, posinf=0, neginf=0)
    channels = np.argsort(-spread, kind="stable")
    rows = int(max(1, min(n, 2_000_000 // max(min(m, back + ahead + 1), 1))))
    row, full, matched = (1 << m) - 1, (1 << m) - 1, 0
    for a in range(0, n, rows):
        b = min(a + rows, n)
        lo, hi = max(0, a - ahead), min(m, b + back)
        if lo >= hi:
            continue
        c = channels[0]
        hit = np.abs(x[a:b, None, c] - y[None, lo:hi, c]) <= tolerance
        gap = np.arange(lo, hi)[None, :] - np.arange(a, b)[:, None]
        hit &= (gap >= -ahead) & (gap <= back)
        i, j = np.nonzero(hit)
        for c in channels[1:]:
            ok = np.abs(x[a + i, c] - y[lo + j, c]) <= tolerance
            i, j = i[ok], j[ok]
        hit[:] = False
        hit[i, j] = True
        some = hit.any(1)
        matched += int(some.sum())
        if matched + (n - b) < least:
            return matched
        bits = np.packbits(hit, axis=1, bitorder="little")
        for r in np.flatnonzero(some):
            mask = int.from_bytes(bits[r].tobytes(), "little") << lo
            u = row & mask
            row = ((row + u) | (row - u)) & full
    return m - row.bit_count()


def compare_pairs(pairs: DataFrame, steps: DataFrame, limits: DataFrame) -> DataFrame:
    """Exact comparison of candidate pairs (a, b): a, b, share of the longer one's frames, for shares of 80 % on."""
    sides = pairs.select("a", "b").distinct()
    wanted = sides.select("a", "b", F.explode(F.array(F.struct(F.col("a").alias("episode_key"), F.lit(0).alias("side")), F.struct(F.col("b").alias("episode_key"), F.lit(1).alias("side")))).alias("s")).select("a", "b", "s.episode_key", "s.side")
    frames = steps.where(F.col("frame_index").isNotNull()).select("episode_key", "frame_index", "state", "action")
    tolerance = limits.select("episode_key", (F.col("joint_limit") * TOLERANCE).alias("tolerance"))
    joined = frames.join(wanted.join(tolerance, "episode_key"), "episode_key")
    keyed = joined.repartition("a", "b").sortWithinPartitions("a", "b", "side", "frame_index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tbl in whole_groups(batches, ["a", "b"]):
            tbl = _distinct_frames(tbl, ["a", "b", "side"])
            x, a, b, side, tol = _coded(tbl), column(tbl, "a"), column(tbl, "b"), column(tbl, "side"), column(tbl, "tolerance")
            starts = np.append(change_points(a, b), len(a))
            rows = []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                cut = s + int(np.searchsorted(side[s:e], 1))
                n, m = cut - s, e - cut
                need = SHARE * max(n, m) - 1e-9
                if n and m and min(n, m) >= need:
                    got = common_frames(x[s:cut], x[cut:e], tol[s] * (1 + 1e-9), int(np.ceil(need)))
                    if got >= need:
                        rows.append((a[s], b[s], got / max(n, m)))
            if rows:
                r = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(r[0], pa.int64()), pa.array(r[1], pa.int64()), pa.array(r[2], pa.float64())], names=["a", "b", "share"])

    return keyed.mapInArrow(run, LINK)


def deliveries(episodes: DataFrame, sources: DataFrame) -> DataFrame:
    """episode_key, embodiment, batch_no, joint_limit; a batch that ``sources`` lacks comes last."""
    once = episodes.where(F.col("episode_key").isNotNull() & F.col("embodiment").isNotNull()).groupBy("episode_key").agg(F.min(F.struct("source_id", "revision", "embodiment")).alias("e")).select("episode_key", "e.*")
    batches = sources.groupBy("source_id", "revision").agg(F.min("batch_no").alias("batch_no"))
    units = sources.groupBy("source_id").agg(F.max("joint_limit").alias("joint_limit"))
    named = once.join(batches, ["source_id", "revision"], "left").join(units, "source_id", "left")
    return named.select("episode_key", "embodiment", F.coalesce("batch_no", F.lit(NO_BATCH)).alias("batch_no"), "joint_limit")


def repeated_episodes(steps: DataFrame, episodes: DataFrame, sources: DataFrame) -> DataFrame:
    """Each repeating episode with the first one of its family: episode_key_a, episode_key_b (smaller first), first.

    An episode repeats another of its embodiment if 80 % of the longer one's
    frames reappear in order with every component within 0.001 of the joint limit;
    null, NaN and the infinities agree only with themselves. Families are the
    connected components; the first episode is the smallest (batch_no, episode_key).
    Redelivered rows count once. Episodes without frames, embodiment or joint
    limit, and null keys, repeat nothing. Exact copies are contracted to one class
    before the search, so a group of them costs one node. Extra columns are
    ignored; empty tables give none.
    """
    listed = cut_lineage(deliveries(episodes, sources))
    limits = listed.select("episode_key", "joint_limit")
    sketches = episode_sketches(steps, limits)
    points = cut_lineage(sketches.join(listed, "episode_key"))
    order = F.struct("batch_no", "episode_key")
    same = ["embodiment", "frames", "digest"]
    classes = points.groupBy(*same).agg(F.min(order).alias("head"))
    copies = points.select("episode_key", *same).join(classes, same).where(F.col("episode_key") != F.col("head.episode_key")).select(F.col("head.episode_key").alias("a"), F.col("episode_key").alias("b"))
    heads = points.join(classes.select(F.col("head.episode_key").alias("episode_key")), "episode_key", "left_semi")
    known = points.select("embodiment", "batch_no").distinct()
    ranks = known.withColumn("batch_rank", F.row_number().over(Window.partitionBy("embodiment").orderBy("batch_no")) - 1)
    most = ranks.agg(F.max("batch_rank")).head()[0]
    found = candidates(heads.join(ranks, ["embodiment", "batch_no"]), (most or 0) + 1)
    pairs = cut_lineage(found.groupBy("a", "b").agg(F.min("distance").alias("distance")))
    links = _verified(pairs, steps, limits, heads.count())
    every = cut_lineage(links.select("a", "b").unionByName(copies.select("a", "b")))
    families = connected_components(every.select(F.col("a").alias("u"), F.col("b").alias("v")))
    members = families.withColumnRenamed("node", "episode_key").join(listed.select("episode_key", "batch_no"), "episode_key")
    first = members.groupBy("component").agg(F.min(order).alias("head"))
    told = members.join(first, "component").where(F.col("episode_key") != F.col("head.episode_key"))
    return told.select(F.least("episode_key", "head.episode_key").alias("episode_key_a"), F.greatest("episode_key", "head.episode_key").alias("episode_key_b"), F.col("head.episode_key").alias("first"))


def _verified(pairs: DataFrame, steps: DataFrame, limits: DataFrame, nodes: int) -> DataFrame:
    """Links among the candidate pairs that join components.

    Where there are many more pairs than episodes (large families of near copies),
    each episode's lowest and nearest partner are compared first and pairs inside
    one component are left out afterwards: they could not join anything.
    """
    done = None
    for _ in range(3):
        if pairs.count() <= 4 * nodes + 1000:
            break
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance"))
        near = both.groupBy("a").agg(F.min("b").alias("low"), F.min_by("b", "distance").alias("near")).select("a", F.explode(F.array("low", "near")).alias("b"))
        near = cut_lineage(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        links = cut_lineage(compare_pairs(near, steps, limits))
        done = links if done is None else done.unionByName(links)
        parts = connected_components(done.select(F.col("a").alias("u"), F.col("b").alias("v")))
        left = pairs.join(near, ["a", "b"], "left_anti")
        left = left.join(parts.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(parts.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
        pairs = cut_lineage(left.where("ca is null or cb is null or ca <> cb").select("a", "b", "distance"))
    rest = compare_pairs(pairs, steps, limits)
    return rest if done is None else done.unionByName(rest)
