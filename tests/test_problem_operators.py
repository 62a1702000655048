"""Grid, drift, known-at and spike operators against brute force, and their defined edge cases."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinelake.operators import known_at, regular_grid, schema_drift, spikes

NAN, INF = float("nan"), float("inf")


# --- regular grid ---------------------------------------------------------------------------

READ = "episode_key bigint, ord bigint, t double, vals array<double>"


def grid(spark, rows, rates, **kw):
    out = regular_grid.regularize(spark.createDataFrame(rows, READ), spark.createDataFrame(rates, "episode_key bigint, fps double"), **kw).collect()
    return {(r.episode_key, r.slot): r for r in out}


def test_slots_match_the_definition(spark):
    rng = random.Random(1)
    rows, rates, want = [], [], set()
    for key in range(12):
        fps = rng.choice([10.0, 15.0, 29.97])
        rates.append((key, fps))
        times = sorted({round(i / fps + rng.uniform(-0.3, 0.3) / fps, 5) for i in range(60) if rng.random() > 0.15})
        rows += [(key, i, t, [math.sin(t), float(key)]) for i, t in enumerate(times)]
        filled = {math.floor((t - times[0]) * fps + 0.5) for t in times}
        want |= {(key, s) for s in range(max(filled) + 1) if s not in filled}
    got = grid(spark, rows, rates)
    assert {k for k, r in got.items() if r.missing} == want
    assert all(len(r.value) == 2 and all(map(math.isfinite, r.value)) for r in got.values())


def test_smoother_equals_a_dense_solution(spark):
    """The smoothed level is the Gaussian posterior mean, computed directly from the joint covariance."""
    rng = np.random.default_rng(3)
    t = np.sort(rng.uniform(0, 3, 25))
    y = np.sin(t) + rng.normal(0, 0.01, 25)
    st = np.arange(0, 31) / 10
    m, sd = regular_grid._smooth(np.zeros(25, int), t, y[:, None], np.zeros(31, int), st)
    q, r = regular_grid._noise(np.array([25]), t[None], y[None, :, None])
    start = min(t[0], st[0])
    p0 = (np.abs(y).max() + 1.0) ** 2 * 4

    def cov(a, b):  # an integrated random walk from `start`, diffuse level and slope
        a, b = a - start, b - start
        lo, hi = min(a, b), max(a, b)
        return p0 + p0 * a * b + q[0, 0] * (lo**3 / 3 + lo**2 * (hi - lo) / 2)

    k = np.array([[cov(a, b) for b in t] for a in t]) + r[0, 0] * np.eye(25)
    c = np.array([[cov(a, b) for b in t] for a in st])
    want = y[0] + c @ np.linalg.solve(k, y - y[0])
    np.testing.assert_allclose(m[:, 0], want, atol=1e-5)
    var = np.array([cov(a, a) for a in st]) - np.einsum("ij,ji->i", c, np.linalg.solve(k, c.T))
    np.testing.assert_allclose(sd[:, 0], np.sqrt(np.maximum(var, 0)), atol=1e-3)


def test_chunks_do_not_change_slots_and_hardly_values(spark):
    rng = random.Random(5)
    rows = [(1, i, i / 10 + rng.uniform(-0.01, 0.01), [math.sin(i / 15)]) for i in range(900) if rng.random() > 0.1]
    whole, cut = grid(spark, rows, [(1, 10.0)]), grid(spark, rows, [(1, 10.0)], chunk=100, halo=40)
    assert whole.keys() == cut.keys() and all(whole[k].missing == cut[k].missing for k in whole)
    assert max(abs(whole[k].value[0] - cut[k].value[0]) for k in whole) < 0.02


def test_grid_edge_cases(spark):
    rows = [
        (1, 0, 0.0, [1.0]), (1, 0, 0.0, [1.0]), (1, 3, 0.3, [NAN]), (1, 4, 0.4, None), (1, 5, 0.5, [None]),
        (2, 0, 0.0, [1.0]), (3, 0, 0.0, [1.0]), (4, 0, 0.0, [1.0]), (5, 0, 0.0, [1.0]), (None, 0, 0.0, [1.0]), (6, 0, 7.0, None),
    ]
    got = grid(spark, rows, [(1, 10.0), (2, None), (3, NAN), (4, 0.0), (5, -1.0), (6, 10.0), (7, 10.0), (None, 1.0)])
    assert {s for k, s in got if k == 1} == set(range(6)) and {s for (k, s), r in got.items() if r.missing} == {1, 2}
    assert got[1, 3].value[0] == pytest.approx(1.0, abs=0.5)
    assert {k for k, _ in got} == {1, 6} and got[6, 0].value == []
    assert grid(spark, [], [(1, 10.0)]) == {}


def test_readings_of_both_kinds(spark):
    steps = spark.createDataFrame([(1, 0, 0.5, [1.0], "x"), (1, 1, NAN, [1.0], "x"), (1, 2, None, [1.0], "x")], "episode_key bigint, frame_index bigint, step_time double, state array<double>, fps string")
    xr = spark.createDataFrame([(2, 4, 100, [1.0]), (2, 5, 200, None), (3, 4, 100, [2.0]), (3, 9, None, [2.0])], "episode_key bigint, idx bigint, clock_ticks bigint, qpos array<double>")
    eps = spark.createDataFrame([(1, 10.0, "timestamps", None), (2, 10.0, "nominal_index", None), (3, 10.0, "field", 0.001)], "episode_key bigint, fps double, timing_mode string, scale_to_seconds double")
    got = sorted((r.episode_key, r.t) for r in regular_grid.episode_readings(steps, xr, eps).collect())
    assert got == [(1, 0.5), (2, 0.4), (3, 0.1)]


# --- attributes as known --------------------------------------------------------------------

EVENT, ATTR = "entity bigint, event_id bigint, event_time double, payload string", "entity bigint, attribute_id bigint, holds_from double, known_from double, payload string"


def test_known_at_equals_brute_force(spark):
    rng = random.Random(2)
    events = [(e, i, round(rng.uniform(-5, 60), 1), "clash") for e in range(6) for i in range(60)]
    attrs = [(e, e * 100 + i, round(rng.uniform(-5, 60), 1), None, f"v{i}") for e in range(6) for i in range(40)]
    attrs = [(e, a, h, round(h + rng.choice([0, 0, 0.5, 9, -3]), 1), p) for e, a, h, _, p in attrs]
    for bucket in (4.0, 1000.0):
        got = {(r.entity, r.event_id): (r.attribute_id, r.payload) for r in known_at.attributes_known_at(spark.createDataFrame(events + events[:9], EVENT), spark.createDataFrame(attrs + attrs[:9], ATTR), bucket).collect()}
        want = {}
        for e, i, t, _ in events:
            ok = [(h, k, a, p) for x, a, h, k, p in attrs if x == e and h <= t and k <= t]
            if ok:
                want[e, i] = max(ok)[2:]
        assert got == want


def test_known_at_edge_cases(spark):
    events = [(1, 0, 5.0, None), (1, 1, NAN, None), (1, 2, None, None), (None, 3, 5.0, None), (2, 4, 5.0, None), (1, 5, 1e12, None), (1, 6, 4.0, None)]
    attrs = [(1, 7, 1.0, None, "x"), (1, 8, NAN, 1.0, "x"), (None, 9, 1.0, 1.0, "x"), (1, 10, 4.0, 4.0, "a"), (1, 11, 4.0, 4.0, "b")]
    got = {r.event_id: r.attribute_id for r in known_at.attributes_known_at(spark.createDataFrame(events, EVENT), spark.createDataFrame(attrs, ATTR)).collect()}
    assert got == {0: 11, 5: 11, 6: 11}  # the interval is closed at its start, the greater id wins a tie
    none = spark.createDataFrame([], ATTR)
    assert known_at.attributes_known_at(spark.createDataFrame(events, EVENT), none).count() == 0
    assert known_at.attributes_known_at(spark.createDataFrame([], EVENT), spark.createDataFrame(attrs, ATTR)).count() == 0


def test_blank_annotations_never_hold(spark):
    steps = spark.createDataFrame([(1, 0, 9.0)], "episode_key bigint, frame_index bigint, step_time double")
    notes = spark.createDataFrame([(5, 1, 1.0, 1.0, "go"), (6, 1, 2.0, 2.0, " 　 "), (7, 1, 3.0, 3.0, None)], "annotation_id bigint, episode_key bigint, said_at double, known_at double, content string")
    assert [tuple(r) for r in known_at.annotation_at_steps(steps, notes).collect()] == [(1, 0, 5, "go")]


# --- schema drift ---------------------------------------------------------------------------


def test_payload_layouts_agree():
    listed = {"metadata": {"codebase_version": "v2.1"}, "features": [{"key": "a", "dtype": "double", "shape": "[8]"}, {"name": "b", "dtype": "str", "shape": 1}, {"key": "c", "dtype": "video", "shape": "480x640x3"}]}
    mapped = {"codebase_version": "2.1", "features": {"a": {"dtype": "float64", "shape": [8]}, "b": {"dtype": "string", "shape": [1]}, "c": {"dtype": "Video", "shape": [480, 640, 3]}}}
    assert schema_drift.parse_payload(json.dumps(listed)) == schema_drift.parse_payload(json.dumps(mapped))
    for bad in (None, "", "{", "[1]", "3", '{"a": 1}'):
        assert schema_drift.parse_payload(bad)[0] is False


def test_assignment_is_minimal():
    from itertools import permutations

    rng = np.random.default_rng(4)
    for n, m in [(3, 3), (2, 5), (5, 2), (1, 1), (0, 3)]:
        for _ in range(20):
            c = rng.random((n, m))
            got = sum(c[i, j] for i, j in schema_drift.assignment(c))
            small, large = min(n, m), max(n, m)
            t = c if n <= m else c.T
            want = min((sum(t[i, p[i]] for i in range(small)) for p in permutations(range(large), small)), default=0)
            assert got == pytest.approx(want)
    c = np.array([[np.inf, np.inf], [0.1, np.inf]])
    assert schema_drift.assignment(c) == [(1, 0)]


def brute_changes(files):
    """The statement of the problem, file by file."""
    out = set()
    last = {}
    for i, ds, _, payload in sorted(files, key=lambda f: (f[2], f[0])):
        ok, version, feats = schema_drift.parse_payload(payload)
        if not ok:
            continue
        new = {n: (d, s) for n, d, s in feats}
        if ds in last:
            old, old_version = last[ds]
            gone, come = set(old) - set(new), set(new) - set(old)
            for sig in {old[n] for n in gone} | {new[n] for n in come}:
                g, c = [n for n in gone if old[n] == sig], [n for n in come if new[n] == sig]
                if len(g) == len(c) == 1:
                    out.add((i, c[0], "renamed"))
                else:
                    out |= {(i, n, "removed") for n in g} | {(i, n, "added") for n in c}
            for n in set(old) & set(new):
                if old[n][0] != new[n][0]:
                    out.add((i, n, "dtype_changed"))
                if old[n][1] != new[n][1]:
                    out.add((i, n, "shape_changed"))
            if version != old_version:
                out.add((i, "codebase_version", "version_changed"))
        last[ds] = new, version
    return out


def test_changes_equal_brute_force(spark):
    import datetime as dt

    rng = random.Random(6)
    files = []
    for i in range(160):
        names = rng.sample(["a", "b", "c", "d", "A", "e", "f"], rng.randint(2, 6))
        doc = {"codebase_version": rng.choice(["v2.0", "2.0", "v2.1"]), "features": {n: {"dtype": rng.choice(["double", "float64", "int64"]), "shape": rng.choice([[1], "1", [2]])} for n in names}}
        text = json.dumps(doc) if rng.random() > 0.1 else rng.choice([None, "{", json.dumps(doc)[:30]])
        files.append((i, f"ds{rng.randint(0, 3)}", dt.datetime(2026, rng.randint(1, 6), rng.randint(1, 28), tzinfo=dt.UTC), text))
    df = spark.createDataFrame(files + files[:30], "inspection_id bigint, dataset_id string, inspected_at timestamp, payload string").withColumn("field", F.lit("clash"))
    got = [(r.inspection_id, r.field, r.change) for r in schema_drift.schema_changes(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_changes(files)
    assert schema_drift.schema_changes(df.limit(0)).count() == 0
    assert schema_drift.schema_changes(df.withColumn("dataset_id", F.lit(None).cast("string"))).count() == 0


def test_unify_follows_renames_and_reports(spark):
    a = spark.createDataFrame([(i, f"n{i}", 1.5 * i) for i in range(30)], "id bigint, label string, old double")
    b = spark.createDataFrame([(i, f"n{i}", 2) for i in range(30)], "id bigint, label_v2 string, extra int")
    c = spark.createDataFrame([(str(i), f"n{i}") for i in range(30)], "id string, label_v2 string")
    table, report = schema_drift.unify([a, b, c])
    assert table.count() == 90 and set(table.columns) == {"id", "label_v2", "old", "extra"}
    assert table.where("label_v2 is null").count() == 0 and dict(table.dtypes)["id"] == "string"
    assert {(r["version"], r["field"], r["change"]) for r in report} == {(1, "label_v2", "renamed"), (1, "old", "removed"), (1, "extra", "added"), (2, "id", "dtype_changed"), (2, "extra", "removed")}


# --- implausible values ---------------------------------------------------------------------

STEP = "source_id string, episode_key bigint, frame_index bigint, state array<double>, action array<double>, dim int"


def series(n, seed=0):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 20 * np.sin(t / 25 + seed) + rng.normal(0, 0.05, n)


def flagged(spark, rows, limits=(("s", 50.0),), **kw):
    src = spark.createDataFrame(list(limits), "source_id string, joint_limit double")
    got = spikes.implausible(spark.createDataFrame(rows, STEP), src, **kw).collect()
    out = {(r.episode_key, r.frame_index, r.field, r.dim): r.kind for r in got}
    assert len(out) == len(got)
    return out


def as_rows(key, x, y=None, source="s"):
    y = x if y is None else y
    return [(source, key, i, [float(a), 1.0], [float(b), 9e9], 0) for i, (a, b) in enumerate(zip(x, y, strict=True))]


def planted(n=400):
    x = series(n)
    x[50] += 15  # one frame
    x[100:103] -= 12  # three frames
    x[150:] += 8  # a lasting change of level
    x[200:204] += 9  # four frames are no spike
    x[250] = NAN
    x[260] = 51.0
    x[300:308] = x[300]  # eight equal values
    x[320:327] = x[320]  # seven are no run
    x[380] = -INF
    want = {50: "spike", 100: "spike", 101: "spike", 102: "spike", 250: "limit", 260: "limit", 380: "limit", **{i: "stuck" for i in range(300, 308)}}
    return x, want


def test_planted_values_are_found_whatever_the_cut(spark):
    x, want = planted()
    rows = as_rows(1, x, series(400, 1)) + as_rows(2, series(400, 2)) + as_rows(2, series(400, 2))[:50]
    for kw in ({}, {"chunk": 64}):
        got = flagged(spark, rows, **kw)
        assert got == {(1, i, "state", 0): k for i, k in want.items()}


def test_spike_edge_cases(spark):
    assert flagged(spark, []) == {}
    x, want = planted()
    rows = as_rows(1, x)
    rows += [("s", 3, 0, None, None, 0), ("s", None, 0, [99.0, 0.0], [99.0, 0.0], 0), ("s", 4, 0, [99.0, NAN], [], 0), ("s", 4, 1, [None, 1.0], None, 0)]
    rows += [("nowhere", 5, i, [float(v), 0.0], [], 0) for i, v in enumerate([1e6, NAN, 2.0])] + [(None, 6, 0, [INF, 0.0], [1.0], 0)]
    got = flagged(spark, rows)
    rest = {k: v for k, v in got.items() if k[0] != 1}
    assert rest == {(4, 0, "state", 0): "limit", (4, 1, "state", 0): "limit", (5, 1, "state", 0): "limit", (6, 0, "state", 0): "limit"}
    assert sum(k[0] == 1 and k[2] == "state" for k in got) == len(want)


def test_autoregression_recovers_coefficients(spark):
    rng = np.random.default_rng(8)
    x = np.zeros(4000)
    for i in range(2, 4000):
        x[i] = 1.2 * x[i - 1] - 0.4 * x[i - 2] + rng.normal(0, 0.5)
    model = {r.source_id: r.model for r in spikes.autoregression(spikes._keyed(spark.createDataFrame(as_rows(1, x), STEP), 4096)).collect()}["s"][0]
    assert 1.0 < model.phi1 < 1.5 and 0.3 < model.sigma < 0.6


def test_columns_parse_like_documents(spark):
    """The JVM's parser and the one for a single document agree on every layout."""
    layouts = [
        {"metadata": {"codebase_version": "v2.1"}, "features": [{"key": "a", "dtype": "double", "shape": "[08]"}, {"name": "b", "dtype": " STR", "shape": 1}, {"key": "a", "dtype": "int64", "shape": []}, {"dtype": "x"}, 3]},
        {"codebase_version": " V3.0", "features": {"z": {"dtype": "float64", "shape": [8.0, 2]}, "y": "video", "x": {"shape": "480x640x3"}, "w": None}},
        {"metadata": {"features": {"a": {"dtype": "bool", "shape": [1]}}, "codebase_version": None}, "codebase_version": 2},
        {"features": []}, {"features": {}}, {"features": "a"}, {"a": 1}, [1], 3,
    ]
    texts = [json.dumps(x) for x in layouts] + ["", "{", None, json.dumps(layouts[0])[:40]]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, payload string")
    got = df.select("i", schema_drift.parsed(F.col("payload")).alias("p")).orderBy("i").collect()
    for r, text in zip(got, texts, strict=True):
        ok, version, feats = schema_drift.parse_payload(text)
        assert bool(r.p.readable) == ok
        if ok:
            assert r.p.version == version and sorted(map(tuple, r.p.features), key=str) == sorted(feats, key=str), text


def test_renames_without_common_values_are_matched():
    a = [{"name": "text", "dtype": "string", "width": 700.0, "distinct": 0.9, "sketch": [1, 2]}, {"name": "source", "dtype": "string", "width": 12.0, "distinct": 0.01, "sketch": [5, 6]}]
    b = [{"name": "origin", "dtype": "string", "width": 12.0, "distinct": 0.01, "sketch": [5, 6]}, {"name": "body_text", "dtype": "string", "width": 690.0, "distinct": 0.95, "sketch": [8, 9]}]
    assert schema_drift.match_columns(a, b) == {"text": "body_text", "source": "origin"}
