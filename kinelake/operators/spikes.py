"""Implausible values in measured vectors: spikes, stuck runs and physical limits.

Steps are written once as blocks (an episode's chunk of frames as matrices), which
three scans read. Two fit a robust autoregression of order two per source, field and
channel: weights first come from second differences, then from the residuals of that
fit, whose distribution is counted, too. The third tests every series: an additive
outlier of one to three values is what the autoregression, interpolating between the
values around it, cannot account for, where a shift of level explains the residuals
less well and the level returns. The greatest outlier of a neighbourhood is replaced
by its interpolation and the rest tested again, until none is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.session import change_points, column, cut_lineage, padded, vectors, whole_groups

#: Rows of one chunk of an episode, and rows of context on each side.
CHUNK, HALO = 4096, 32
#: A spike stands off by this many times what nine tenths of the residuals of its source and channel stay below.
FAR, REGULAR = 8.0, 0.9
#: The level after a spike differs from the one before by at most this share of the spike.
RETURN = 0.5
#: What an outlier or shift must gain in squared residual deviations for each number it fits.
PENALTY = 10.0
STUCK, LONGEST = 8, 3
#: Residuals are counted by their size in so many classes per doubling, within so many doublings of the first fit's deviation.
CLASSES, DOUBLINGS = 16, 24
#: Bytes of values that one step of a scan handles at once.
CELLS = 4 << 20
SUMS = ["w", "s11", "s12", "s22", "sy1", "sy2", "syy"]
BLOCK_SCHEMA = "source_id string, episode_key bigint, chunk bigint, frames binary, widths binary, state_width int, action_width int, cells binary"
FIT_SCHEMA = f"source_id string, channel int, size int, {', '.join(f'{c} double' for c in SUMS)}"
FOUND_SCHEMA = "episode_key bigint, frame_index bigint, field string, dim int, kind string, value double, score double"


def _keyed(steps: DataFrame, chunk: int) -> DataFrame:
    """Blocks: the rows of an episode's chunk with their halo, in order of frame_index, repeated rows once."""
    c = F.col("frame_index")
    parts = F.array_distinct(F.array(F.floor(F.greatest(c - HALO, F.least(c, F.lit(0))) / chunk), F.floor(c / chunk), F.floor((c + HALO) / chunk)))
    rows = steps.where(F.col("episode_key").isNotNull() & c.isNotNull()).select("source_id", "episode_key", "frame_index", "state", "action", F.explode(parts).alias("chunk"))
    keyed = rows.repartition("episode_key", "chunk").sortWithinPartitions("episode_key", "chunk", "frame_index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tbl in whole_groups(batches, ["episode_key", "chunk"]):
            yield _blocks(tbl)

    return keyed.mapInArrow(run, BLOCK_SCHEMA)


def _blocks(tbl: pa.Table) -> pa.RecordBatch:
    key, chunk, frame = (column(tbl, c) for c in ("episode_key", "chunk", "frame_index"))
    keep = np.zeros(len(key), bool)
    keep[change_points(key, chunk, frame)] = True
    if not keep.all():
        tbl, key, chunk, frame = tbl.filter(pa.array(keep)), key[keep], chunk[keep], frame[keep]
    starts = change_points(key, chunk)
    ends = np.append(starts[1:], len(key))
    lists = [vectors(tbl, name) for name in ("state", "action")]
    mats, widths = [padded(*v) for v in lists], np.stack([np.diff(v[1]) for v in lists], 1).astype(np.int32)
    most = np.maximum.reduceat(widths, starts, axis=0)
    cells = [np.concatenate([mats[0][a:b, :s], mats[1][a:b, :t]], 1).tobytes() for a, b, (s, t) in zip(starts, ends, most, strict=True)]
    return pa.RecordBatch.from_arrays(
        [tbl.column("source_id").combine_chunks().take(pa.array(starts)), pa.array(key[starts]), pa.array(chunk[starts]), pa.array([frame[a:b].astype(np.int64).tobytes() for a, b in zip(starts, ends, strict=True)]), pa.array([widths[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]), pa.array(most[:, 0]), pa.array(most[:, 1]), pa.array(cells, pa.binary())],
        schema=pa.schema([("source_id", pa.string()), ("episode_key", pa.int64()), ("chunk", pa.int64()), ("frames", pa.binary()), ("widths", pa.binary()), ("state_width", pa.int32()), ("action_width", pa.int32()), ("cells", pa.binary())]),
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds few blocks' cells (one block at least)."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch.column(batch.schema.get_field_index("cells"))).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + CELLS, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def _series(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """All blocks of a batch as one matrix; the last channel of each vector (the gripper) is left out."""
    get = {name: batch.column(batch.schema.get_field_index(name)) for name in batch.schema.names}
    ws, wa = (get[c].to_numpy(zero_copy_only=False).astype(int) for c in ("state_width", "action_width"))
    at, width = int(ws.max()), int(ws.max() + wa.max())
    frames = [np.frombuffer(v, np.int64) for v in get["frames"].to_pylist()]
    length = np.array([len(f) for f in frames])
    starts = np.concatenate([[0], np.cumsum(length)])
    x, widths = np.full((starts[-1], width), np.nan), np.concatenate([np.frombuffer(v, np.int32).reshape(-1, 2) for v in get["widths"].to_pylist()])
    for g, v in enumerate(get["cells"].to_pylist()):
        if ws[g] + wa[g]:
            m = np.frombuffer(v).reshape(-1, ws[g] + wa[g])
            x[starts[g] : starts[g + 1], : ws[g]], x[starts[g] : starts[g + 1], at : at + wa[g]] = m[:, : ws[g]], m[:, ws[g] :]
    place = np.arange(width)
    present = np.where(place < at, place[None, :] < widths[:, :1] - 1, place[None, :] - at < widths[:, 1:] - 1)
    group = np.repeat(np.arange(len(length)), length)
    return {"x": x, "present": present, "group": group, "starts": starts, "frame": np.concatenate(frames), "actions_at": at, "source": get["source_id"], **({"model": get["model"]} if "model" in get else {})}


def _models(s: dict) -> np.ndarray:
    """Per block and column: phi1, phi2, deviation, regular residual (NaN where the source has no fit)."""
    col = s["model"]
    flat = col.flatten().to_numpy(zero_copy_only=False).reshape(-1, 5)
    n = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) // 5
    g, c = np.repeat(np.arange(len(n)), n), flat[:, 0].astype(int)
    c = np.where(c < 1000, c, s["actions_at"] + c - 1000)
    out = np.full((len(n), s["x"].shape[1], 4), np.nan)
    ok = (c < s["x"].shape[1]) & ((flat[:, 0] >= 1000) | (c < s["actions_at"]))
    out[g[ok], c[ok]] = flat[ok, 1:]
    return out


def _residuals(x: np.ndarray, group: np.ndarray, phi: np.ndarray) -> np.ndarray:
    """One-step residuals; before a block's second row its first values are held."""
    before = np.maximum(np.arange(len(x)) - 1, np.searchsorted(group, group))
    first, second = x[before], x[np.maximum(before - 1, np.searchsorted(group, group))]
    return x - phi[group, :, 0] * first - phi[group, :, 1] * second


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted sums for the autoregression per source and channel (state channels 0.., action channels 1000..).

    Without a model, weights fall off for large second differences of the series;
    with one, for its large residuals, which are also counted by size.
    """
    for batch in _pieces(batches):
        s = _series(batch)
        x, group, starts = np.where(s["present"] & np.isfinite(s["x"]), s["x"], np.nan), s["group"], s["starts"]
        if len(x) < 3:
            continue
        run = (group[2:] == group[:-2]) & (s["frame"][2:] - s["frame"][:-2] == 2)
        y, a, b = x[2:], x[1:-1], x[:-2]
        names, code = np.unique(np.array(["" if v is None else "s" + v for v in s["source"].to_pylist()], object).astype(str), return_inverse=True)
        with np.errstate(all="ignore"):
            if "model" in s:
                m = _models(s)[group[2:]]
                off, scale = np.abs(y - m[:, :, 0] * a - m[:, :, 1] * b), 3 * m[:, :, 2]
            else:
                off = np.abs(y - 2 * a + b)
                bad = ~np.isfinite(off) | ~run[:, None]
                scale = 2.5 * 1.4826 * _group_median(np.where(bad, np.inf, off), group[2:], len(starts) - 1)
            bad = ~np.isfinite(off) | ~run[:, None] | ~np.isfinite(scale)
            w = np.where(bad, 0.0, np.where(off == 0, 1.0, np.minimum(1.0, (scale / np.maximum(off, 1e-300)) ** 2)))
            yy, aa, bb = (np.where(bad, 0.0, v) for v in (y, a, b))
            cells = np.stack([w, w * aa * aa, w * aa * bb, w * bb * bb, w * yy * aa, w * yy * bb, w * yy * yy], 2)
        sums = np.zeros((len(names), x.shape[1], len(SUMS)))
        per = np.add.reduceat(np.concatenate([cells, np.zeros((1, *cells.shape[1:]))]), np.searchsorted(group[2:], np.arange(len(starts) - 1)), axis=0)
        per[np.bincount(group[2:], minlength=len(starts) - 1) == 0] = 0
        np.add.at(sums, code, per)
        src, col = np.nonzero(sums[:, :, 0] > 0)
        out = [(src, col, np.full(len(src), -1), sums[src, col])]
        if "model" in s:
            with np.errstate(all="ignore"):
                size = np.clip(np.nan_to_num(np.floor(CLASSES * np.log2(off / m[:, :, 2])), nan=0, posinf=1e6, neginf=-1e6), -CLASSES * DOUBLINGS, CLASSES * DOUBLINGS).astype(np.int64) + CLASSES * DOUBLINGS
            r, c = np.nonzero(~bad)
            places = 2 * CLASSES * DOUBLINGS + 1
            at, n = np.unique((code[group[2:][r]] * x.shape[1] + c) * places + size[r, c], return_counts=True)
            counted = np.zeros((len(at), len(SUMS)))
            counted[:, 0] = n
            out.append((at // places // x.shape[1], at // places % x.shape[1], at % places, counted))
        src, col, size, values = (np.concatenate(v) for v in zip(*out, strict=True))
        channel = np.where(col < s["actions_at"], col, 1000 + col - s["actions_at"]).astype(np.int32)
        labels = pa.array([None if n == "" else n[1:] for n in names], pa.string()).take(pa.array(src))
        yield pa.RecordBatch.from_arrays([labels, pa.array(channel), pa.array(size.astype(np.int32)), *(pa.array(values[:, i]) for i in range(len(SUMS)))], names=["source_id", "channel", "size", *SUMS])


def _group_median(x: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Each row's median of its group and column over the finite values; so weights depend on the series alone."""
    out = np.empty_like(x)
    first = np.searchsorted(group, np.arange(groups))
    for c in range(x.shape[1]):
        order = np.lexsort((x[:, c], group))
        n = np.bincount(group, np.isfinite(x[:, c]), minlength=groups).astype(np.int64)
        at = np.minimum(first + np.maximum(n - 1, 0) // 2, len(x) - 1)
        out[:, c] = np.where(n > 0, x[order[at], c], 0.0)[group]
    return out


def _solved(sums: DataFrame) -> DataFrame:
    """Coefficients and the weighted residual deviation from the sums; a channel that does not move keeps its last direction."""
    det = F.col("s11") * F.col("s22") - F.col("s12") * F.col("s12")
    ok = (F.col("w") > 3) & (det > 1e-12 * F.col("s11") * F.col("s22"))
    phi1 = F.when(ok, (F.col("sy1") * F.col("s22") - F.col("sy2") * F.col("s12")) / det).otherwise(2.0)
    phi2 = F.when(ok, (F.col("sy2") * F.col("s11") - F.col("sy1") * F.col("s12")) / det).otherwise(-1.0)
    rss = F.expr("syy - 2 * (phi1 * sy1 + phi2 * sy2) + phi1 * phi1 * s11 + 2 * phi1 * phi2 * s12 + phi2 * phi2 * s22")
    return sums.select("*", phi1.alias("phi1"), phi2.alias("phi2")).select("*", F.sqrt(F.greatest(rss / F.col("w"), F.lit(0.0))).alias("sigma"))


def _flat(fitted: DataFrame, *fields: str) -> DataFrame:
    """source_id, model: five numbers per channel in one array (a source has few channels)."""
    row = F.array(F.col("channel").cast("double"), *(F.col(f) for f in fields))
    return fitted.groupBy("source_id").agg(F.flatten(F.collect_list(row)).alias("model"))


def _with_models(blocks: DataFrame, models: DataFrame) -> DataFrame:
    """Blocks with their source's model. Spark broadcasts the models while they are small, else it joins by shuffle."""
    return blocks.join(models.where(F.col("source_id").isNotNull()), "source_id", "left")


def autoregression(keyed: DataFrame) -> DataFrame:
    """Per source: its channels' AR(2) coefficients, residual deviation and regular residual as a map channel -> struct.

    ``sigma`` is the median residual times 1.4826, ``regular`` the size that
    ``REGULAR`` of the residuals stay below.
    """
    total = [F.sum(c).alias(c) for c in SUMS]
    first = _solved(keyed.mapInArrow(_fit, FIT_SCHEMA).groupBy("source_id", "channel").agg(*total))
    first = cut_lineage(first.select("source_id", "channel", "phi1", "phi2", F.greatest("sigma", F.lit(1e-12)).alias("sigma"), F.lit(0.0).alias("none")))
    again = _with_models(keyed, _flat(first, "phi1", "phi2", "sigma", "none"))
    counted = cut_lineage(again.mapInArrow(_fit, FIT_SCHEMA).groupBy("source_id", "channel", "size").agg(*total))
    second = _solved(counted.where("size = -1"))
    sizes = counted.where("size >= 0").groupBy("source_id", "channel").agg(F.array_sort(F.collect_list(F.struct("size", "w"))).alias("sizes"))  # as many as there are classes
    every = F.aggregate("sizes", F.lit(0.0), lambda n, v: n + v["w"])

    def below(share: float) -> F.Column:
        step = F.aggregate("sizes", F.struct(F.lit(0.0).alias("n"), F.lit(-1).alias("at")), lambda acc, v: F.struct((acc["n"] + v["w"]).alias("n"), F.when(acc["n"] < share * F.col("every"), v["size"]).otherwise(acc["at"]).alias("at")))
        return F.col("first_sigma") * F.pow(F.lit(2.0), (step["at"] + 0.5) / CLASSES - DOUBLINGS)

    known = second.join(sizes.withColumn("every", every), ["source_id", "channel"]).join(first.select("source_id", "channel", F.col("sigma").alias("first_sigma")), ["source_id", "channel"])
    known = known.select("source_id", "channel", "phi1", "phi2", (1.4826 * below(0.5)).alias("sigma"), below(REGULAR).alias("regular"))
    return known.groupBy("source_id").agg(F.map_from_entries(F.collect_list(F.struct("channel", F.struct("phi1", "phi2", "sigma", "regular")))).alias("model"))


def implausible(steps: DataFrame, sources: DataFrame, chunk: int = CHUNK, far: float = FAR) -> DataFrame:
    """Flagged components: episode_key, frame_index, field, dim, kind (limit, stuck, spike), value, score.

    ``limit``: not finite, or beyond the source's joint_limit (without a known
    limit only non-finite values). ``stuck``: all values of a run of at least 8
    successive frame_index that stay exactly the same. ``spike``: one to three
    values off what the source's autoregression expects between their neighbours by
    more than ``far`` times its regular residual, with a return to the level before;
    level shifts are none. ``score`` counts residual deviations. A component gets
    one row, limit before stuck before spike. The last channel of a vector, null
    vectors and null keys have none; repeated rows count once; an episode has one
    source. A very long episode is cut into chunks with context, so results do not
    depend on the cut. Extra columns are ignored; empty tables give none.
    """
    keyed = cut_lineage(_keyed(steps, chunk))
    fitted = autoregression(keyed).select("source_id", F.explode("model").alias("channel", "m")).select("source_id", "channel", "m.*")
    models = cut_lineage(_flat(fitted, "phi1", "phi2", "sigma", "regular"))
    limits = sources.where(F.col("source_id").isNotNull()).groupBy("source_id").agg(F.max("joint_limit").alias("joint_limit"))
    known = _with_models(keyed, models).join(limits, "source_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            yield from _flag(batch, chunk, far)

    return known.mapInArrow(run, FOUND_SCHEMA)


def _flag(batch: pa.RecordBatch, chunk: int, far: float) -> Iterator[pa.RecordBatch]:
    s = _series(batch)
    x, present, group, frame, at = s["x"], s["present"], s["group"], s["frame"], s["actions_at"]
    n, width = x.shape
    if not n or not width:
        return
    limit = batch.column(batch.schema.get_field_index("joint_limit")).to_numpy(zero_copy_only=False).astype(float)[group][:, None]
    with np.errstate(all="ignore"):
        beyond = present & (~np.isfinite(x) | (np.abs(x) > limit))
    stuck = _stuck(x, present, group, frame)
    spike, score = _spikes(np.where(present & ~beyond, x, np.nan), group, frame, _models(s), far)

    kind = np.where(beyond, 1, np.where(stuck, 2, np.where(spike, 3, 0)))
    own = batch.column(batch.schema.get_field_index("chunk")).to_numpy(zero_copy_only=False)[group]
    kind[(frame // chunk) != own] = 0  # the halo belongs to other chunks
    r, c = np.nonzero(kind)
    if len(r):
        labels = np.array(["", "limit", "stuck", "spike"], object)
        key, is_state = batch.column(batch.schema.get_field_index("episode_key")).to_numpy(zero_copy_only=False)[group], c < at
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[r]), pa.array(frame[r]), pa.array(np.where(is_state, "state", "action")), pa.array(np.where(is_state, c, c - at).astype(np.int32)), pa.array(labels[kind[r, c]], pa.string()), pa.array(x[r, c]), pa.array(np.where(kind[r, c] == 3, score[r, c], np.nan), from_pandas=True)],
            names=["episode_key", "frame_index", "field", "dim", "kind", "value", "score"],
        )


def _stuck(x: np.ndarray, present: np.ndarray, group: np.ndarray, frame: np.ndarray) -> np.ndarray:
    """Values of a run of ``STUCK`` successive frames or more that stay the same."""
    n = len(x)
    out = np.zeros(x.shape, bool)
    if n >= STUCK:
        follows = (group[1:] == group[:-1]) & (frame[1:] - frame[:-1] == 1)
        same = np.zeros(x.shape, np.int64)
        same[1:] = follows[:, None] & (x[1:] == x[:-1]) & present[1:] & present[:-1]
        total = np.cumsum(same, axis=0)
        full = (total[STUCK - 1 :] - total[: -(STUCK - 1)]) == STUCK - 1  # the 8 rows up to here are equal
        for j in range(STUCK):
            out[j : n - STUCK + 1 + j] |= full
    return out


def _filled(x: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Missing values on the line between the nearest ones of their block and column; held at its ends."""
    row, ok = np.arange(len(x))[:, None], np.isfinite(x)
    last, following = np.maximum.accumulate(np.where(ok, row, -1), axis=0), np.flip(np.minimum.accumulate(np.flip(np.where(ok, row, len(x)), 0), axis=0), 0)
    start = np.searchsorted(group, group)[:, None]
    stop = np.searchsorted(group, group, "right")[:, None]
    has_last, has_next = last >= start, following < stop
    a, b = np.where(has_last, last, following), np.where(has_next, following, last)
    a, b = np.clip(np.where(has_last | has_next, a, 0), 0, len(x) - 1), np.clip(np.where(has_last | has_next, b, 0), 0, len(x) - 1)
    va, vb = np.take_along_axis(x, a, 0), np.take_along_axis(x, b, 0)
    with np.errstate(all="ignore"):
        line = va + (vb - va) * np.where(b > a, (row - a) / np.maximum(b - a, 1), 0.0)
    return np.where(ok, x, np.where(has_last | has_next, line, np.nan))


def _spikes(x: np.ndarray, group: np.ndarray, frame: np.ndarray, models: np.ndarray, far: float) -> tuple[np.ndarray, np.ndarray]:
    """Additive outliers of up to three values, taken greatest first and tested again until there are no more."""
    n, width = x.shape
    found, score, valid = np.zeros((n, width), bool), np.full((n, width), np.nan), np.isfinite(x)
    x = _filled(x, group)
    sigma, least = models[:, :, 2], far * models[:, :, 3]
    while True:
        with np.errstate(all="ignore"):
            e = np.abs(_residuals(x, group, models))
            rows, cols = np.nonzero(e > 0.5 * least[group])  # a spike's first value is a large residual
        best = _outliers(x, rows, cols, group, frame, valid & ~found, models, sigma, least)
        if best is None:
            return found, score
        t, c, length, gain, fit = best
        dense = np.zeros((n, width))
        np.maximum.at(dense, (t, c), gain)
        top = dense.copy()
        for k in range(1, LONGEST + 2):
            same = (group[k:] == group[:-k])[:, None]
            top[k:] = np.maximum(top[k:], np.where(same, dense[:-k], 0))
            top[:-k] = np.maximum(top[:-k], np.where(same, dense[k:], 0))
        first = np.concatenate([[True], (t[1:] != t[:-1]) | (c[1:] != c[:-1])]) if len(t) else np.zeros(0, bool)
        pick = np.flatnonzero((gain >= top[t, c]) & first)
        for j in range(LONGEST):
            i = pick[length[pick] > j]
            at = t[i] + j, c[i]
            new = valid[at] & ~found[at]
            score[at] = np.where(new, np.abs(x[at] - fit[i, j]) / np.maximum(sigma[group[at[0]], at[1]], 1e-300), score[at])
            found[at] |= new
            x[at] = fit[i, j]


def _signature(phi1: np.ndarray, phi2: np.ndarray, length: int) -> np.ndarray:
    """What the residuals of ``length + 2`` rows make of each of ``length + 4`` values: (series, rows, values)."""
    out = np.zeros((len(phi1), length + 2, length + 4))
    for r in range(length + 2):
        out[:, r, r + 2], out[:, r, r + 1], out[:, r, r] = 1.0, -phi1, -phi2
    return out


def _outliers(x: np.ndarray, rows: np.ndarray, cols: np.ndarray, group: np.ndarray, frame: np.ndarray, open_: np.ndarray, models: np.ndarray, sigma: np.ndarray, least: np.ndarray) -> tuple | None:
    """The best outlier that begins at each of the given values: (row, column, length, gain, interpolated values), sorted, or None."""
    n, got = len(x), []
    for length in range(1, LONGEST + 1):
        ok = (rows >= 1) & (rows + length < n)
        t, c = rows[ok], cols[ok]
        ok = (group[t - 1] == group[t]) & (group[t + length] == group[t]) & (frame[t + length - 1] - frame[t] == length - 1) & open_[t, c] & open_[t + length - 1, c]
        t, c = t[ok], c[ok]
        if not len(t):
            continue
        g = group[t]
        before = np.where((t >= 2) & (group[np.maximum(t - 2, 0)] == g), t - 2, t - 1)
        after = np.where((t + length + 1 < n) & (group[np.minimum(t + length + 1, n - 1)] == g), t + length + 1, t + length)
        at = np.stack([before, t - 1, *(t + j for j in range(length)), t + length, after], 1)
        v = x[at, c[:, None]]
        phi1, phi2, sd = models[g, c, 0], models[g, c, 1], np.maximum(sigma[g, c], 1e-300)
        sig = _signature(phi1, phi2, length)
        block, around = sig[:, :, 2 : 2 + length], np.delete(sig, np.s_[2 : 2 + length], 2)
        outer = np.delete(v, np.s_[2 : 2 + length], 1)
        normal = block.transpose(0, 2, 1) @ block
        fit = -np.linalg.solve(normal, block.transpose(0, 2, 1) @ (around @ outer[:, :, None]))[:, :, 0]
        off = v[:, 2 : 2 + length] - fit
        e = (sig @ v[:, :, None])[:, :, 0]
        kept = e - (block @ off[:, :, None])[:, :, 0]
        step = sig[:, :, 2:].sum(2)  # a shift moves the first value and all after it
        shift = e - step * ((step * e).sum(1) / np.maximum((step * step).sum(1), 1e-300))[:, None]
        rss, rss_spike, rss_shift = ((r * r).sum(1) / sd**2 for r in (e, kept, shift))
        gain = rss - rss_spike - PENALTY * length
        smallest = np.abs(off).min(1)
        hit = (smallest > least[g, c]) & (np.abs(np.sign(off).sum(1)) == length) & (gain > 0) & (gain > rss - rss_shift - PENALTY)
        # the level returns, and the values on either side of the spike lie on it
        level = np.stack([v[:, 2 + length] - v[:, 1], v[:, 1] - v[:, 0], v[:, 3 + length] - v[:, 2 + length]])
        hit &= (np.abs(level) < RETURN * smallest).all(0)
        if hit.any():
            got.append((t[hit], c[hit], np.full(hit.sum(), length), gain[hit], np.pad(fit[hit], ((0, 0), (0, LONGEST - length)))))
    if not got:
        return None
    t, c, length, gain, fit = (np.concatenate(v) for v in zip(*got, strict=True))
    order = np.lexsort((-gain, c, t))
    return t[order], c[order], length[order], gain[order], fit[order]


def implausible_components(steps: DataFrame, sources: DataFrame) -> DataFrame:
    return implausible(steps, sources).select("episode_key", "frame_index", "field", "dim")
