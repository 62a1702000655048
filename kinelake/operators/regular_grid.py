"""Irregular readings onto a regular grid by a Kalman smoother.

Each series is a local linear trend in continuous time (an integrated random
walk for the level, observed with noise). The filter runs over the merged time
line of readings and grid slots, the Rauch-Tung-Striebel pass runs back over it,
and every slot comes out with a value and a standard deviation per channel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelake.session import change_points, column, padded, vectors, whole_groups

#: Slots in one chunk of a series, and slots of context read on each side of a chunk.
CHUNK, HALO = 2048, 64
GRID_SCHEMA = "episode_key bigint, slot bigint, grid_time double, value array<double>, sd array<double>, missing boolean"


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def episode_readings(steps: DataFrame, xr_records: DataFrame, episodes: DataFrame) -> DataFrame:
    """Readings of both kinds as (episode_key, ord, t, vals), with a finite time each.

    A step without a state still is a reading (its time is known); an XR record
    without ``qpos`` is none, as in the data's definition.
    """
    clock = episodes.groupBy("episode_key").agg(*(F.first(c).alias(c) for c in ("fps", "timing_mode", "scale_to_seconds")))
    captured = (
        xr_records.where(F.col("qpos").isNotNull())
        .select("episode_key", F.col("idx").alias("ord"), "clock_ticks", F.col("qpos").alias("vals"))
        .join(clock, "episode_key")
        .withColumn(
            "t",
            F.when(F.col("timing_mode") == "nominal_index", F.try_divide(F.col("ord").cast("double"), F.col("fps")))
            .when(F.col("timing_mode") == "field", F.col("clock_ticks") * F.col("scale_to_seconds")),
        )
        .select("episode_key", "ord", "t", "vals")
    )
    recorded = steps.select("episode_key", F.col("frame_index").alias("ord"), F.col("step_time").alias("t"), F.col("state").alias("vals"))
    both = recorded.unionByName(captured)
    return both.where(F.col("episode_key").isNotNull() & finite(F.col("t")))


def regularize(readings: DataFrame, rates: DataFrame, chunk: int = CHUNK, halo: int = HALO) -> DataFrame:
    """One row per period of 1/``fps`` of every series, filled and marked.

    ``readings``: episode_key, ord, t, vals; ``rates``: episode_key, fps. Slot 0
    lies at the earliest reading; a reading fills slot ``floor((t - t0) * fps + 0.5)``.
    Returned: slot, grid_time, the smoothed ``value`` and ``sd`` per channel and
    ``missing`` (no reading fills the slot).

    A series is cut into chunks of ``chunk`` slots, each read with ``halo`` slots
    of context on both sides, so that one very long series spreads over many
    tasks; the smoother forgets what lies further away. A slot whose chunk and
    halo hold no reading of a channel gets a null value and sd there.

    Series without a positive finite fps, and null keys, give no rows. Repeated
    rows count once. NaN or infinite channel values and null vectors are treated
    as not observed. Extra columns are ignored. Empty input gives an empty table.
    """
    rates = (
        rates.groupBy("episode_key").agg(F.first("fps").alias("fps")).where(F.col("episode_key").isNotNull() & finite(F.col("fps")) & (F.col("fps") > 0))
    )
    span = readings.groupBy("episode_key").agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    info = span.join(rates, "episode_key")
    slot_of = lambda t: F.floor((t - F.col("t0")) * F.col("fps") + 0.5)
    info = info.withColumn("last_slot", slot_of(F.col("t1"))).drop("t1")
    placed = readings.select("episode_key", "ord", "t", "vals").join(info, "episode_key").withColumn("slot", slot_of(F.col("t")))
    spread = placed.withColumn(
        "chunk", F.explode(F.sequence(F.greatest(F.floor((F.col("slot") - halo) / chunk), F.lit(0)), F.least(F.floor((F.col("slot") + halo) / chunk), F.floor(F.col("last_slot") / chunk))))
    )
    marks = info.select(
        "episode_key", F.lit(None).cast("bigint").alias("ord"), F.lit(None).cast("double").alias("t"), F.lit(None).cast("array<double>").alias("vals"), "t0", "fps", "last_slot",
        F.lit(-1).cast("bigint").alias("slot"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("last_slot") / chunk))).alias("chunk"),
    )
    keyed = spread.unionByName(marks).repartition("episode_key", "chunk").sortWithinPartitions("episode_key", "chunk", "t", "ord")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tbl in whole_groups(batches, ["episode_key", "chunk"], 12_000):
            yield from _smooth_table(tbl, chunk)

    return keyed.mapInArrow(run, GRID_SCHEMA)


def _smooth_table(tbl: pa.Table, chunk: int) -> Iterator[pa.RecordBatch]:
    key, part = column(tbl, "episode_key"), column(tbl, "chunk")
    starts = change_points(key, part)
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(key))))
    t0, fps, last = (column(tbl, c)[starts] for c in ("t0", "fps", "last_slot"))
    first_slot = part[starts] * chunk
    end_slot = np.minimum(first_slot + chunk - 1, last)
    t, slot = column(tbl, "t").astype(np.float64), column(tbl, "slot")
    ordinal = tbl.column("ord").fill_null(-1).to_numpy()
    flat, offsets = vectors(tbl, "vals")
    y = padded(flat, offsets)
    y[~np.isfinite(y)] = np.nan
    reading = slot >= 0
    same = np.zeros(len(t), bool)
    same[1:] = (group[1:] == group[:-1]) & (t[1:] == t[:-1]) & (ordinal[1:] == ordinal[:-1])
    same[1:] &= ((y[1:] == y[:-1]) | (np.isnan(y[1:]) & np.isnan(y[:-1]))).all(1) if y.shape[1] else True
    reading &= ~same

    n_slots = (end_slot - first_slot + 1).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(n_slots)])
    filled = np.zeros(base[-1], bool)
    inside = reading & (slot >= first_slot[group]) & (slot <= end_slot[group])
    filled[base[group[inside]] + slot[inside] - first_slot[group[inside]]] = True
    sg = np.repeat(np.arange(len(starts)), n_slots)
    s = np.arange(base[-1]) - base[sg] + first_slot[sg]
    grid_t = t0[sg] + s / fps[sg]

    width = y.shape[1]
    dims = np.zeros(len(starts), np.int64)
    np.maximum.at(dims, group, np.diff(offsets))
    value, sd = np.full((len(s), width), np.nan), np.full((len(s), width), np.nan)
    if width:
        rows_in = np.bincount(group[reading], minlength=len(starts)) + n_slots
        order = np.argsort(rows_in, kind="stable")
        r_at = np.flatnonzero(reading)
        lo, lim = 0, 60_000
        while lo < len(order):  # groups of like length share one pass, so that little of the padding is wasted
            hi = lo + 1
            while hi < len(order) and rows_in[order[hi]] * (hi + 1 - lo) <= lim and rows_in[order[hi]] <= 2 * rows_in[order[lo]] + 64:
                hi += 1
            chosen = np.zeros(len(starts), bool)
            chosen[order[lo:hi]] = True
            ri, gi = r_at[chosen[group[r_at]]], np.flatnonzero(chosen[sg])
            v, d = _smooth(group[ri], t[ri] - t0[group[ri]], y[ri], sg[gi], grid_t[gi] - t0[sg[gi]])
            value[gi], sd[gi] = v, d
            lo = hi

    cells = np.arange(width)[None, :] < dims[sg][:, None]
    ends = np.concatenate([[0], np.cumsum(cells.sum(1))]).astype(np.int32)

    def lists(m: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(m[cells], from_pandas=True))

    out = pa.table({
        "episode_key": key[starts][sg], "slot": s.astype(np.int64), "grid_time": grid_t,
        "value": lists(value), "sd": lists(sd), "missing": ~filled,
    })
    yield from out.to_batches(max_chunksize=20_000)


def _noise(length: np.ndarray, t: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Process and measurement variance of each series and channel from second differences at two spans.

    For the local linear trend the variance of a second difference over span h is
    2/3 q h^3 + 6 r; medians of squares at h and 2h give both unknowns robustly.
    """
    g, width, dims = y.shape
    med = []
    for lag in (1, 2):
        d2 = y[:, 2 * lag :] - 2 * y[:, lag:-lag] + y[:, : -2 * lag] if width > 2 * lag else np.full((g, 1, dims), np.nan)
        with np.errstate(all="ignore"):
            med.append(_nanmedian(d2 * d2) / 0.4549)
    with np.errstate(all="ignore"):
        span = np.where(np.isfinite(t), t, np.nan)
        h = np.nanmax(span, axis=1) - np.nanmin(span, axis=1)
    h = np.where(np.isfinite(h) & (h > 0), h, 1.0) / np.maximum(length - 1, 1)
    scale = np.nanmax(np.where(np.isfinite(y), np.abs(y), 0), axis=1) + 1e-9
    v1, v2 = (np.where(np.isfinite(m), m, (0.1 * scale) ** 2) for m in med)
    q = np.maximum((v2 - v1) / (2 / 3 * 7 * h[:, None] ** 3), 1e-8 * scale**2 / h[:, None] ** 3)
    r = np.maximum((v1 - 2 / 3 * q * h[:, None] ** 3) / 6, 1e-8 * scale**2)
    return q, r


def _nanmedian(x: np.ndarray) -> np.ndarray:
    """Median along axis 1 without NaN; NaN where there is nothing."""
    x = np.sort(x, axis=1)  # NaN last
    n = np.isfinite(x).sum(1)
    mid = np.take_along_axis(x, np.maximum(n - 1, 0)[:, None] // 2, axis=1)[:, 0]
    return np.where(n > 0, mid, np.nan)


def _smooth(rg: np.ndarray, rt: np.ndarray, ry: np.ndarray, sg: np.ndarray, st: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed level and its deviation at the grid times of several series at once.

    Readings (group, time, values) and grid points (group, time), each sorted by
    group and time. Series run side by side, one numpy step per position.
    """
    ids = np.unique(sg)
    rg, sg = np.searchsorted(ids, rg), np.searchsorted(ids, sg)
    groups, dims = len(ids), ry.shape[1]
    g, tt, kind = np.concatenate([rg, sg]), np.concatenate([rt, st]), np.concatenate([np.zeros(len(rg), np.int8), np.ones(len(sg), np.int8)])
    order = np.lexsort((kind, tt, g))
    g, tt, kind = g[order], tt[order], kind[order]
    count = np.bincount(g, minlength=groups)
    pos = np.arange(len(g)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    steps = int(count.max())
    time = np.full((steps, groups), np.nan)
    time[pos, g] = tt
    obs = np.full((steps, groups, dims), np.nan)
    is_reading = kind == 0
    obs[pos[is_reading], g[is_reading]] = ry[order[is_reading]]

    n_read = np.bincount(rg, minlength=groups)
    rpos = np.arange(len(rg)) - np.repeat(np.concatenate([[0], np.cumsum(n_read)[:-1]]), n_read)
    only = np.full((groups, max(int(n_read.max(initial=1)), 1), dims), np.nan)
    only_t = np.full(only.shape[:2], np.nan)
    only[rg, rpos], only_t[rg, rpos] = ry, rt
    q, r = _noise(n_read, only_t, only)

    has = np.isfinite(only)
    first = np.argmax(has, axis=1)
    level = np.where(has.any(1), np.take_along_axis(only, first[:, None, :], axis=1)[:, 0], np.nan)
    seen_any = has.any(1)
    level = np.where(seen_any, level, 0.0)
    wide = (np.nanmax(np.where(has, np.abs(only), 0), axis=1) + 1.0) ** 2 * 4
    a, b = level.copy(), np.zeros_like(level)
    p11, p12, p22 = wide.copy(), np.zeros_like(wide), wide.copy()
    dt = np.zeros((steps, groups))
    dt[1:] = np.where(np.isfinite(time[1:]), time[1:] - time[:-1], 0.0)
    keep = np.empty((5, steps, groups, dims))
    for k in range(steps):
        h = dt[k][:, None]
        if k:
            a = a + b * h
            p11 = p11 + h * (2 * p12 + h * (p22 + q * h / 3))
            p12 = p12 + h * (p22 + q * h / 2)
            p22 = p22 + q * h
        seen = np.isfinite(obs[k])
        if seen.any():
            gain = np.where(seen, 1.0 / (p11 + r), 0.0)
            k1, k2 = p11 * gain, p12 * gain
            err = np.where(seen, obs[k] - a, 0.0)
            a, b = a + k1 * err, b + k2 * err
            p22 = p22 - k2 * p12
            p12, p11 = p12 * (1 - k1), p11 * (1 - k1)
        keep[:, k] = a, b, p11, p12, p22
    sa, sb, s11, s12, s22 = keep[:, -1].copy()
    out_m, out_v = np.empty((steps, groups, dims)), np.empty((steps, groups, dims))
    out_m[-1], out_v[-1] = sa, s11
    for k in range(steps - 2, -1, -1):
        h = dt[k + 1][:, None]
        fa, fb, f11, f12, f22 = keep[:, k]
        m11 = f11 + h * (2 * f12 + h * (f22 + q * h / 3))
        m12 = f12 + h * (f22 + q * h / 2)
        m22 = f22 + q * h
        det = np.maximum(m11 * m22 - m12 * m12, 1e-300)
        c1, c2 = f11 + h * f12, f12 + h * f22  # columns of P F'
        g11, g12 = (c1 * m22 - f12 * m12) / det, (f12 * m11 - c1 * m12) / det
        g21, g22 = (c2 * m22 - f22 * m12) / det, (f22 * m11 - c2 * m12) / det
        da, db = sa - (fa + fb * h), sb - fb
        d11, d12, d22 = s11 - m11, s12 - m12, s22 - m22
        still = h == 0
        na = np.where(still, sa, fa + g11 * da + g12 * db)
        nb = np.where(still, sb, fb + g21 * da + g22 * db)
        n11 = f11 + g11 * (g11 * d11 + g12 * d12) + g12 * (g11 * d12 + g12 * d22)
        n12 = f12 + g11 * (g21 * d11 + g22 * d12) + g12 * (g21 * d12 + g22 * d22)
        n22 = f22 + g21 * (g21 * d11 + g22 * d12) + g22 * (g21 * d12 + g22 * d22)
        s11, s12, s22 = np.where(still, s11, n11), np.where(still, s12, n12), np.where(still, s22, n22)
        sa, sb = na, nb
        out_m[k], out_v[k] = sa, s11
    at = np.empty(len(g), np.int64)
    at[order] = np.arange(len(g))
    grid = at[len(rg) :]
    m, v = out_m[pos[grid], g[grid]], out_v[pos[grid], g[grid]]
    none = ~seen_any[g[grid]]
    m[none], v[none] = np.nan, np.nan
    return m, np.sqrt(np.maximum(v, 0))


def missing_slots(grid: DataFrame) -> DataFrame:
    return grid.where("missing").select("episode_key", "slot")
