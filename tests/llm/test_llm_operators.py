"""The training-data operators against brute force, planted cases and held-out accuracy."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinelake.llm import families, history, language, mixing, nearest_time, packing, small_world

NAN, INF = float("nan"), float("inf")

# --- nearest in time ------------------------------------------------------------------------

REC, EV = "entity_1 string, entity_2 string, record_id bigint, record_time double", "entity_1 string, entity_2 string, event_a bigint, event_b bigint, target double, low double, high double, a int"


def nearest(spark, rec, ev, tol=0.04, **kw):
    got = nearest_time.match_nearest(spark.createDataFrame(rec, REC), spark.createDataFrame(ev, EV), tol, **kw).collect()
    out = {(r.event_a, r.event_b): r.record_id for r in got}
    assert len(out) == len(got)
    return out


def brute_nearest(rec, ev, tol):
    out = {}
    for e1, e2, a, b, t, lo, hi, _ in ev:
        if t is None or not np.isfinite(t) or e1 is None or e2 is None:
            continue
        ok = [(abs(t - x), i) for r1, r2, i, x in rec if (r1, r2) == (e1, e2) and x is not None and np.isfinite(x) and x >= (-INF if lo is None else lo) and x < (INF if hi is None else hi) and abs(t - x) <= tol]
        if ok:
            out[a, b] = min(ok)[1]
    return out


def test_nearest_equals_brute_force(spark):
    rng = random.Random(1)
    rec = [(f"s{rng.randint(0, 2)}", f"v{rng.randint(0, 2)}", i, round(rng.uniform(-3, 70), 4)) for i in range(3000)]
    rec += [(a, b, i + 5000, t) for a, b, i, t in rec[:300]]  # equal times under two ids
    rec += [("s0", "v0", 9000 + i, 16.0 + d) for i, d in enumerate((-0.03, 0.03, 0, 1e-9, -1e-9, 2e-7))]  # a block's border
    ev = []
    for i in range(1500):
        lo = rng.choice([None, 0.0, 5.0, 16.0])
        ev.append((f"s{rng.randint(0, 2)}", f"v{rng.randint(0, 3)}", i, 0, round(rng.uniform(-4, 72), 4), lo, rng.choice([None, (lo or 0) + 20.0]), 1))
    ev += [("s0", "v0", 2000 + i, 1, 16.0 + d, None, None, 1) for i, d in enumerate((0, 1e-9, 5e-8, -0.01, 0.04, 0.07))]
    for tol in (0.04, 1.0):
        assert nearest(spark, rec, ev, tol) == brute_nearest(rec, ev, tol)


def test_nearest_edge_cases(spark):
    rec = [("s", "v", 7, 1.0), ("s", "v", 3, 1.0), ("s", "v", 9, 1.02), ("s", None, 1, 1.0), ("s", "v", 4, NAN), ("s", "v", 5, None), ("s", "v", 6, INF), ("s", "v", 8, -0.0)]
    ev = [("s", "v", 1, 0, 1.0, None, None, 0), ("s", "v", 2, 0, 1.01, None, None, 0), ("s", "v", 3, 0, NAN, None, None, 0), ("s", None, 4, 0, 1.0, None, None, 0), ("s", "v", 5, 0, None, None, None, 0), ("s", "w", 6, 0, 1.0, None, None, 0), ("s", "v", 7, 0, 1.0, 1.01, None, 0), ("s", "v", 8, 0, 0.0, 0.0, 1.0, 0), ("s", "v", 9, 0, 1.02, None, 1.02, 0)]
    got = nearest(spark, rec, ev)
    assert got[1, 0] == 3 and got[7, 0] == 9 and got[8, 0] == 8 and got[9, 0] == 3
    assert got[2, 0] == brute_nearest(rec, ev, 0.04)[2, 0] and set(got) == {(1, 0), (2, 0), (7, 0), (8, 0), (9, 0)}
    assert nearest(spark, [], ev) == {} and nearest(spark, rec, []) == {}


def test_trie_predecessor():
    rng = np.random.default_rng(2)
    ent, key = np.unique(np.stack([rng.integers(0, 5, 4000), rng.integers(0, 2**12, 4000)], 1), axis=0).T
    trie = nearest_time.XFastTrie(ent, key, 12)
    qe, qk = rng.integers(0, 6, 3000), rng.integers(0, 2**12, 3000)
    want = []
    for e, k in zip(qe, qk):
        below = np.flatnonzero((ent == e) & (key <= k))
        want.append(below[-1] if len(below) else -1)
    assert trie.predecessor(qe, qk).tolist() == want


# --- components and splits ------------------------------------------------------------------


def find_components(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(200)] + [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(5000, 5000)]
    df = spark.createDataFrame(edges + edges[:50] + [(None, 3), (4, None)], "u bigint, v bigint")
    got = {r.node: r.component for r in families.connected_components(df).collect()}
    assert got == find_components(edges)
    assert families.connected_components(df.limit(0)).count() == 0


def test_a_hot_node_is_split_by_a_skew_join(spark, monkeypatch):
    """The join of edges and minima in a round: with nearly all edges on one node its plan has a skew join."""
    plans = []
    real = families.cut_lineage

    def spying(df):
        out = real(df)
        plans.append(df)
        return out

    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "65536"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        edges = spark.range(1, 60000).select(F.when(F.col("id") % 10 < 9, F.lit(0)).otherwise(F.col("id") + 100_000).alias("u"), (F.col("id") + 200_000).alias("v")).repartition(8)
        monkeypatch.setattr(families, "cut_lineage", spying)
        got = families.connected_components(edges).groupBy("component").count().orderBy(F.desc("count")).head()
        assert got["component"] == 0 and got["count"] == 53_999 + 1
        down = next(p for p in plans if "v" in p.columns and "m" not in p.columns and p is not plans[0])
        down.collect()
        assert "skew=true" in down._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


EP = "episode_key bigint, origin_group string, derived_from bigint, split string, component string"


def test_families_and_torn_splits(spark):
    rows = [
        (5, "A_x:session-007", None, "train", "z"), (9, " a-X:SESSION_7 ", None, "VAL ", "z"), (9, " a-X:SESSION_7 ", None, "VAL ", "z"), (12, None, 9, None, "z"),
        (20, None, None, "train", "z"), (21, "  ", None, "test", "z"), (22, "", 20, " Train", "z"), (30, "g:session-70", None, "val", "z"), (31, "g:session-7", None, "test", "z"), (40, None, 999, "test", "z"), (None, "g", None, "train", "z"), (50, "h:session-00", None, "validation", "z"), (51, "h:session-0", 50, " val", "z"),
    ]
    df = spark.createDataFrame(rows, EP)
    assert {tuple(r) for r in families.torn_families(df).collect()} == {(5, 5), (5, 9), (5, 12)}
    named = {r.episode_key: r for r in families.episode_families(df).collect()}
    assert named[5].split == named[12].split and named[51].component == 50 and named[31].component == 31 and len(named) == 11
    assert families.torn_families(df.limit(0)).count() == 0


def test_split_shares(spark):
    df = families.assign_splits(spark.range(20000).select(F.col("id").alias("component")), families.SHARES)
    share = {r.split: r["count"] / 20000 for r in df.groupBy("split").count().collect()}
    assert share["train"] == pytest.approx(0.8, abs=0.01) and share["test"] == pytest.approx(0.1, abs=0.01)


# --- history dedup --------------------------------------------------------------------------


def test_graph_recall_against_exhaustive_search():
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(40, 24))
    base = (centers[rng.integers(0, 40, 6000)] + rng.normal(0, 0.3, (6000, 24))).astype(np.float32)
    q = base[:300] + rng.normal(0, 0.05, (300, 24)).astype(np.float32)
    graph = small_world.SmallWorld(base)
    assert graph.tune(10) >= 0.9
    ids, _ = graph.search(q, 10)
    want, _ = small_world.exhaustive(base, q, 10)
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids, want, strict=True)]) >= 0.9


def test_common_frames_is_the_longest_common_subsequence():
    rng = np.random.default_rng(7)
    for _ in range(30):
        x, y = rng.integers(0, 4, (12, 2)).astype(float), rng.integers(0, 4, (15, 2)).astype(float)
        table = np.zeros((13, 16), int)
        for i in range(12):
            for j in range(15):
                table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + int(np.abs(x[i] - y[j]).max() <= 0.5))
        assert history.common_frames(x, y, 0.5) == table[-1, -1]


STEP = "episode_key bigint, frame_index bigint, state array<double>, action array<double>, source_id string, digest string"
EPISODE = "episode_key bigint, source_id string, revision string, embodiment string, frames int"


def walks(n, length, seed):
    rng = np.random.default_rng(seed)
    return {k: np.cumsum(rng.normal(0, 0.05, (length + k % 7, 6)), 0) + rng.uniform(-1, 1, 6) for k in range(1, n + 1)}


def test_repeats_are_found_with_their_first(spark):
    eps = walks(60, 40, 5)
    rng = np.random.default_rng(9)
    where = {k: ("a", f"r{k % 5}") for k in eps}
    eps[101], where[101] = eps[7][3:].copy(), ("a", "r4")  # cut at the start
    eps[102], where[102] = eps[7] + rng.uniform(-0.001, 0.001, eps[7].shape), ("b", "r0")  # noise, another source of the embodiment
    eps[103], where[103] = eps[8].copy(), ("a", "r0")  # exact copy, delivered before
    eps[104], where[104] = eps[9][::-1].copy(), ("a", "r1")  # reversed: no repeat
    eps[105], where[105] = eps[10][: int(len(eps[10]) * 0.7)].copy(), ("a", "r1")  # too short
    eps[106], where[106] = eps[11].copy(), ("c", "r0")  # another embodiment
    eps[107], where[107] = np.delete(eps[12], [4, 11, 17, 30], 0), ("a", "r2")  # dropped frames
    eps[12][20, 3] = eps[107][17 - 1, 3] = NAN
    eps[108], where[108] = eps[13].copy(), ("a", "r1")
    eps[108][:, 2] += 0.01  # beyond the tolerance
    eps[109], where[109] = eps[101][2:].copy(), ("b", "r1")  # a copy of a copy
    steps = [(k, i, [float(v) for v in row[:3]], [float(v) for v in row[3:]], "clash", "x") for k, m in eps.items() for i, row in enumerate(m)]
    steps += steps[:40] + [(None, 0, [1.0], [1.0], "x", "x"), (200, 0, None, None, "x", "x")]
    episodes = [(k, s, r, "arm" if s != "c" else "hand", 0) for k, (s, r) in where.items()]
    episodes += episodes[:5] + [(200, "a", "r0", None, 0), (201, "a", "r0", "arm", 0)]
    sources = [(s, f"r{i}", 5 * j + i + 1, 1.0) for j, s in enumerate("abc") for i in range(5)]
    args = spark.createDataFrame(steps, STEP), spark.createDataFrame(episodes, EPISODE), spark.createDataFrame(sources, "source_id string, revision string, batch_no int, joint_limit double")
    got = {(r.episode_key_a, r.episode_key_b) for r in history.repeated_episodes(*args).collect()}
    order = {k: ("abc".index(s) * 5 + int(r[1]) + 1, k) for k, (s, r) in where.items()}
    want = set()
    for family in ({7, 101, 102, 109}, {8, 103}, {12, 107}):
        first = min(family, key=order.get)
        want |= {(min(first, k), max(first, k)) for k in family if k != first}
    assert got == want
    assert history.repeated_episodes(args[0].limit(0), args[1], args[2]).count() == 0


def test_large_family_of_near_copies_is_one_component(spark):
    base = walks(1, 30, 3)[1]
    rng = np.random.default_rng(4)
    eps = {k: base + rng.uniform(-0.0004, 0.0004, base.shape) for k in range(1, 80)} | {k + 100: m for k, m in walks(30, 30, 8).items()}
    steps = [(k, i, [float(v) for v in row[:3]], [float(v) for v in row[3:]], "s", "x") for k, m in eps.items() for i, row in enumerate(m)]
    args = spark.createDataFrame(steps, STEP), spark.createDataFrame([(k, "a", "r0", "arm", 0) for k in eps], EPISODE), spark.createDataFrame([("a", "r0", 1, 1.0)], "source_id string, revision string, batch_no int, joint_limit double")
    got = {(r.episode_key_a, r.episode_key_b) for r in history.repeated_episodes(*args).collect()}
    assert got == {(1, k) for k in range(2, 80)}


def test_new_batch_needs_only_the_shards(spark):
    eps = walks(50, 40, 6)
    eps[61] = eps[20][2:].copy()
    steps = spark.createDataFrame([(k, i, [float(v) for v in row[:3]], [float(v) for v in row[3:]], "s", "x") for k, m in eps.items() for i, row in enumerate(m)], STEP)
    points = history.episode_sketches(steps, spark.createDataFrame([(k, 1.0) for k in eps], "episode_key bigint, joint_limit double")).withColumn("embodiment", F.lit("arm")).withColumn("batch_rank", F.col("episode_key") % 5)
    stored = history.compacted(points.where("episode_key < 60"), 5)
    assert stored.select("shard").distinct().count() == 2  # 5 = 4 + 1 batches
    found = {(r.a, r.b) for r in history.batch_against_history(points.where("episode_key > 60"), stored).collect()}
    assert (20, 61) in found and all(b == 61 for _, b in found)


def test_sketch_of_an_episode_does_not_depend_on_its_table():
    rng = np.random.default_rng(2)
    frames = {k: (rng.normal(size=(30, w)), rng.normal(size=(30, w))) for k, w in ((1, 6), (2, 8), (3, 7))}
    frames[4] = frames[1]

    def sketched(keys):
        rows = [(k, i, 30, 2.0, list(frames[k][0][i]), list(frames[k][1][i])) for k in keys for i in range(30)]
        tbl = pa.table(dict(zip(("episode_key", "frame_index", "span", "joint_limit", "state", "action"), map(list, zip(*rows, strict=True)), strict=True)))
        return {r["episode_key"]: (r["digest"], r["sketch"]) for r in history._sketch_table(tbl).to_pylist()}

    mixed = sketched([1, 2, 3, 4])
    assert all(mixed[k] == sketched([k])[k] for k in frames)
    assert mixed[1] == mixed[4] and [len(mixed[k][1]) for k in (1, 2, 3)] == [60, 80, 70]


def test_repeats_are_found_among_mixed_widths(spark):
    """One embodiment with 3 and 5 channels; a 5-channel episode whose last ones are null in every frame repeats a 3-channel one."""
    eps = {k: (m[:, :3], m[:, 3:]) for k, m in walks(30, 40, 5).items()}
    eps |= {k + 100: (np.hstack([m[:, :3], m[:, :2] + 1]), np.hstack([m[:, 3:], m[:, 4:] + 1])) for k, m in walks(30, 40, 6).items()}
    eps[201], eps[202] = eps[4], tuple(v[2:] for v in eps[105])
    eps[203] = tuple(np.hstack([v[1:], np.full((len(v) - 1, 2), NAN)]) for v in eps[6])
    steps = [(k, i, [float(v) for v in s], [None if np.isnan(v) else float(v) for v in a], "s", "x") for k, m in eps.items() for i, (s, a) in enumerate(zip(*m, strict=True))]
    steps = [(r[0], r[1], [None if np.isnan(v) else v for v in r[2]], *r[3:]) for r in steps]
    args = spark.createDataFrame(steps, STEP), spark.createDataFrame([(k, "a", "r0", "arm", 0) for k in eps], EPISODE), spark.createDataFrame([("a", "r0", 1, 1.0)], "source_id string, revision string, batch_no int, joint_limit double")
    assert {(r.episode_key_a, r.episode_key_b) for r in history.repeated_episodes(*args).collect()} == {(4, 201), (105, 202), (6, 203)}


def test_every_partner_within_bounds_is_a_candidate(spark):
    """A dense shard: hundreds of takes lie within one another's bounds, many more than a list of nearest ones holds."""
    rng = np.random.default_rng(6)
    base = np.sort(rng.uniform(-1, 1, (1, 4, 5)), 2)
    x = np.concatenate([np.sort(base + rng.normal(0, 0.03, (300, 4, 5)), 2), np.sort(rng.uniform(-1, 1, (700, 4, 5)), 2)]).reshape(1000, 20).astype(np.float32)
    n = rng.integers(80, 140, 1000)
    i, j = np.triu_indices(1000, 1)
    ok = (np.minimum(n[i], n[j]) >= 0.8 * np.maximum(n[i], n[j]) - 1e-9) & history.within_bounds(x[i], x[j])
    want = set(zip(i[ok].tolist(), j[ok].tolist(), strict=True))
    assert len(want) > 300 * 16
    rows = [(k, "arm", k % 20, int(n[k]), [float(v) for v in x[k]]) for k in range(1000)]
    points = spark.createDataFrame(rows, "episode_key bigint, embodiment string, batch_rank int, frames bigint, sketch array<float>")
    assert {(r.a, r.b) for r in history.candidates(points, 20).collect()} == want


# --- packing --------------------------------------------------------------------------------


def test_packing_keeps_everything_within_capacity(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, 1, 30, 200, 511, 512, 513, 1023, 1024, 1025, 3000]), "x") for i in range(2500)]
    df = spark.createDataFrame(rows + rows[:60] + [(None, 5, "x"), (9999, None, "x")], "doc_id bigint, n_tokens bigint, sequence string")
    got = packing.pack(df).collect()
    sizes, placed, spans = {i: n for i, n, _ in rows} | {9999: 0}, Counter(), defaultdict(list)
    for r in got:
        placed[r.doc_id] += r.n_tokens
        assert (r.sequence is None) == (sizes[r.doc_id] == 0)
        if r.sequence:
            spans[r.sequence].append((r.position, r.position + r.n_tokens))
            assert r.n_tokens == 1024 or r.n_tokens <= sizes[r.doc_id]
    assert set(placed) == set(sizes) and all(placed[k] == v for k, v in sizes.items())
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and s[-1][1] <= 1024 and all(a[1] == b[0] for a, b in zip(s, s[1:]))
    whole = [r for r in got if sizes[r.doc_id] <= 1024]
    assert max(Counter(r.doc_id for r in whole).values()) == 1  # nothing else is split
    assert len(spans) * 1024 * 0.99 <= sum(sizes.values()) + 3 * 1024
    assert packing.pack(df.limit(0)).count() == 0


def test_genetic_step_never_loses_items_and_improves():
    rng = np.random.default_rng(1)
    sizes = rng.integers(200, 700, 300).tolist()
    first = packing.build(list(range(300)), sizes, 1024)
    other = packing.build(rng.permutation(300).tolist(), sizes, 1024)
    for made in (packing.crossover(first, other, sizes, rng), packing.mutate(first, sizes, rng)):
        assert sorted(i for b in made.bins for i in b) == list(range(300))
        assert all(sum(sizes[i] for i in b) + f == 1024 for b, f in zip(made.bins, made.free, strict=True))
    pop = packing.evolve(sizes, 1024, [packing._genome(first, 300)], 3)
    assert len(pop[0].bins) <= len(first.bins) and pop[0].fitness() >= first.fitness()


# --- mixing ---------------------------------------------------------------------------------


def test_water_fill():
    assert mixing.water_fill({"a": 0.5, "b": 0.5}, {"a": 10.0, "b": 1000.0}, 100) == {"a": 10.0, "b": 90.0}
    assert mixing.water_fill({"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 10.0, "b": 20.0}, 100) == {"a": 10.0, "b": 20.0, "c": 0.0}
    got = mixing.water_fill({"a": 0.25, "b": 0.25, "c": 0.5}, {"a": 10.0, "b": 35.0, "c": 1000.0}, 100)
    assert got["a"] == 10 and got["b"] == pytest.approx(30) and got["c"] == pytest.approx(60)
    assert mixing.water_fill({}, {}, 5) == {}


def test_mix_reaches_shares_and_respects_caps(spark):
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        source = rng.choices([" Big", "big", "small", None, "other", "tiny"], [30, 30, 6, 2, 10, 0.3])[0]
        text = f"t{rng.randint(0, 5000)}"
        rows.append((i, source, text, 10 + int(text[1:]) % 90, 1))
    df = spark.createDataFrame(rows + rows[:100] + [(7000, "big", None, 0, 1), (None, "big", "x", 5, 1)], "doc_id bigint, source string, text_key string, n_tokens bigint, copies int")
    targets = spark.createDataFrame([("big", 0.5, 1), ("SMALL ", 0.3, 4), ("tiny", 0.1, 2), ("absent", 0.1, 9)], "source string, target_share double, max_repeats int")
    draws, report = mixing.mix(df, targets)
    got, told = draws.collect(), {r.source: r for r in report.collect()}
    total = sum(r[3] for r in rows)
    text = {r[0]: r[2] for r in rows}
    assert len({text[r.doc_id] for r in got}) == len(got)  # no text under two documents
    cap = {"big": 1, "small": 4, "tiny": 2}
    assert all(1 <= r.copies <= cap[r.source] for r in got)
    drawn = Counter()
    for r in got:
        drawn[r.source] += r.copies * r.n_tokens
    assert all(told[s].drawn_tokens == n for s, n in drawn.items()) and told["absent"].drawn_tokens == 0
    assert sum(drawn.values()) == pytest.approx(total / 2, rel=0.01) or all(told[s].epochs >= cap[s] - 1e-9 for s in cap)
    want = mixing.water_fill({"big": 0.5, "small": 0.3, "tiny": 0.1, "absent": 0.1}, {s: told[s].tokens * cap[s] for s in cap}, total / 2)
    assert all(drawn[s] == pytest.approx(want[s], abs=100) for s in cap)
    assert mixing.mix(df.limit(0), targets)[0].count() == 0 and mixing.mix(df, targets.limit(0))[0].count() == 0
    assert sorted(map(tuple, mixing.mix(df.repartition(7), targets)[0].collect())) == sorted(map(tuple, got))


# --- languages ------------------------------------------------------------------------------

PARTS = {
    "en": (["The operator", "Our camera", "The left gripper", "A new cable"], ["was moved to the shelf", "did not reach the box", "should be checked before lunch", "came back after the review"], ["because of the dust", "while we waited", "and nobody knows why", "with both hands"]),
    "de": (["Der Bediener", "Unsere Kamera", "Der linke Greifer", "Ein neues Kabel"], ["wurde auf das Regal gelegt", "erreichte die Kiste nicht", "sollte vor der Pause geprüft werden", "kam nach der Durchsicht zurück"], ["wegen des Staubs", "während wir warteten", "und niemand weiß warum", "mit beiden Händen"]),
    "es": (["La operadora", "Nuestra cámara", "La pinza izquierda", "Un cable nuevo"], ["quedó en el estante", "no llegó a la caja", "debe revisarse antes de comer", "volvió tras la revisión"], ["por culpa del polvo", "mientras esperábamos", "y nadie sabe por qué", "con las dos manos"]),
    "pt": (["A operadora", "A nossa câmera", "A garra esquerda", "Um cabo novo"], ["ficou na prateleira", "não chegou à caixa", "deve ser verificada antes do almoço", "voltou depois da revisão"], ["por causa da poeira", "enquanto esperávamos", "e ninguém sabe por quê", "com as duas mãos"]),
    "fr": (["L'opératrice", "Notre caméra", "La pince gauche", "Un câble neuf"], ["est restée sur l'étagère", "n'a pas atteint la boîte", "doit être vérifiée avant midi", "est revenue après la revue"], ["à cause de la poussière", "pendant que nous attendions", "et personne ne sait pourquoi", "avec les deux mains"]),
    "zh": (["操作员", "我们的相机", "左边的夹爪", "新的电缆"], ["被放到了架子上", "没有够到箱子", "应该在午饭前检查", "复核以后又回来了"], ["因为有灰尘", "当时我们在等", "没有人知道为什么", "用了两只手"]),
}


def sentence(lang, rng):
    a, b, c = (rng.choice(p) for p in PARTS[lang])
    return f"{a}{b}，{c}。" if lang == "zh" else f"{a} {b} {c}."


def corpus(seed, n=240):
    rng = random.Random(seed)
    rows, truth = [], {}
    for i in range(n):
        lang = rng.choice(list(PARTS))
        text = " ".join(sentence(lang, rng) for _ in range(rng.randint(1, 5)))
        label = lang if rng.random() > 0.1 else rng.choice(list(PARTS))
        rows.append((i, text, label, 0))
        truth[i] = lang
    return rows, truth


def test_languages_segments_and_cases(spark):
    rows, truth = corpus(1)
    rng = random.Random(2)
    mixed = {}
    for i in range(1000, 1030):
        a, b = rng.sample(list(PARTS), 2)
        text = "# NOTE 12\n" + " ".join(sentence(a, rng) for _ in range(2)) + "\n\n" + sentence(b, rng) + ' "bitte warten"\n' + sentence(b, rng).replace(".", " err#77 [sync lost].")
        rows.append((i, text, a, 0))
        mixed[i] = [a, b]
    long = " ".join(sentence("fr", rng) for _ in range(4000))
    rows += [(2000, None, "en", 0), (2001, "", None, 0), (2002, " \n ", "und", 0), (2003, "1.5 -2.25\n0.1", None, 0), (2004, sentence("en", rng), " EN-us", 0), (2005, sentence("de", rng), "German", 0), (2006, sentence("zh", rng), "zho", 0), (2007, sentence("pt", rng), "n/a", 0), (2008, sentence("es", rng), "it", 0), (2009, long, None, 0), (None, sentence("en", rng), None, 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, segment_no int")
    seg = language.document_segments(df).collect()
    found = defaultdict(list)
    for r in sorted(seg, key=lambda r: (r.doc_id, r.segment_no)):
        found[r.doc_id].append(r.language)
        assert 0 < r.confidence <= 1 and r.start < r.stop
    right = sum(found[i] == [t] for i, t in truth.items())
    assert right >= 0.98 * len(truth)
    assert sum(found[i] == m for i, m in mixed.items()) >= 0.95 * len(mixed)
    assert not {2000, 2001, 2002, 2003, None} & set(found) and found[2009] == ["fr"]
    cases = {(r.doc_id, r.segment_no, r.language) for r in language.relabelled(df).collect()}
    ids = {c[0] for c in cases}
    assert not {2004, 2005, 2006} & ids and {(2007, 0, "pt"), (2008, 0, "es"), (2009, 0, "fr")} <= cases
    assert all((i in ids) == (rows[i][2] != truth[i]) for i in truth if found[i] == [truth[i]])
    assert language.relabelled(df.limit(0)).count() == 0


def test_kernel_weights_equal_the_kernel():
    """The multiplied-out weights give the scores of kernel times coefficients; held-out sentences are classified."""
    rng = random.Random(3)
    names = list(PARTS)
    texts = [(sentence(c, rng).lower(), i) for i, c in enumerate(names) for _ in range(60)]
    model = language.KernelModel([t for t, _ in texts], [c for _, c in texts], len(names), landmarks=60)
    held = [(sentence(c, rng).lower(), i) for i, c in enumerate(names) for _ in range(30)]
    scores = model.scores([t for t, _ in held])
    assert (scores.argmax(1) == np.array([c for _, c in held])).mean() >= 0.98
    t = held[0][0]
    _, grams = language.grams([t])
    own = np.unique(grams[np.isin(grams, model.vocabulary)])
    at = model.table[model._slot(own)]
    np.testing.assert_allclose(scores[0], model.weights[at].sum(0) / np.sqrt(len(own)) + model.bias, rtol=1e-4, atol=1e-5)


def test_genetic_search_beats_best_fit_on_planted_triples():
    """Bins filled exactly by three items each: best fit decreasing needs a sixth more, the search one more at most."""
    for bins, seed in ((20, 1), (40, 2), (80, 3)):
        rng = np.random.default_rng(seed)
        sizes = []
        for _ in range(bins):
            a = int(rng.integers(390, 500))
            b = int(rng.integers(257, 1024 - a - 256))
            sizes += [a, b, 1024 - a - b]
        sizes = rng.permutation(sizes).tolist()
        greedy = packing.build(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes, 1024)
        pop: list = []
        for epoch in range(packing.EPOCHS):
            pop = packing.evolve(sizes, 1024, [packing._genome(p, len(sizes)) for p in pop], seed + epoch)
        assert len(greedy.bins) >= 1.15 * bins and len(pop[0].bins) <= bins + 1
        assert sorted(i for b in pop[0].bins for i in b) == list(range(len(sizes))) and min(pop[0].free) >= 0
        assert all(sum(sizes[i] for i in b) + f == 1024 for b, f in zip(pop[0].bins, pop[0].free, strict=True))


def test_tables_and_pieces_of_long_episodes(spark, monkeypatch):
    """An episode cut into pieces has the sketch of the whole within a rank of its summaries; frames count once."""
    rng = np.random.default_rng(3)
    m = np.cumsum(rng.normal(0, 0.05, (900, 4)), 0)
    rows = [(1, i, [float(v) for v in r[:2]], [float(v) for v in r[2:]], "s", "x") for i, r in enumerate(m)]
    steps = spark.createDataFrame(rows + rows[:50] + [(2, 10_000_000, [0.5, 1.0], [1.0], "s", "x")], STEP)
    limits = spark.createDataFrame([(1, 10.0), (2, 10.0)], "episode_key bigint, joint_limit double")
    whole = {r.episode_key: r for r in history.episode_sketches(steps, limits).collect()}
    monkeypatch.setattr(history, "PIECE", 100)
    cut = {r.episode_key: r for r in history.episode_sketches(steps, limits).collect()}
    assert whole[1].frames == cut[1].frames == 900 and whole[2].frames == cut[2].frames == 1
    np.testing.assert_allclose(cut[1].sketch, whole[1].sketch, atol=0.02)
    assert cut[2].sketch == whole[2].sketch


def test_families_wider_than_any_list_of_neighbours(spark):
    """25 near copies of 60 frames and 25 cut to 51 frames (85 % in common) are one family."""
    rng = np.random.default_rng(2)
    base = np.cumsum(rng.normal(0, 0.05, (60, 6)), 0)
    eps = {k: base + rng.uniform(-0.0004, 0.0004, base.shape) for k in range(1, 26)} | {k: base[:51] + rng.uniform(-0.0004, 0.0004, (51, 6)) for k in range(101, 126)}
    steps = [(k, i, [float(v) for v in row[:3]], [float(v) for v in row[3:]], "s", "x") for k, m in eps.items() for i, row in enumerate(m)]
    args = spark.createDataFrame(steps, STEP), spark.createDataFrame([(k, "a", "r0", "arm", 0) for k in eps], EPISODE), spark.createDataFrame([("a", "r0", 1, 1.0)], "source_id string, revision string, batch_no int, joint_limit double")
    assert {(r.episode_key_a, r.episode_key_b) for r in history.repeated_episodes(*args).collect()} == {(1, k) for k in eps if k != 1}


def test_idle_twins_are_compared_in_linear_memory():
    import tracemalloc

    x = np.full((8000, 12), 0.25)
    y = x + np.random.default_rng(1).uniform(-1e-4, 1e-4, x.shape)
    tracemalloc.start()
    assert history.common_frames(x, y, 1e-3, 6400) == 8000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400e6
    assert history.common_frames(x[:100], y[:100] + 1, 1e-3, 80) < 80


def test_stored_index_compacts_and_answers(spark, tmp_path):
    """Batches added one by one leave the segments of a binary counter; a reopened index finds what brute force finds."""
    rng = np.random.default_rng(8)
    x = np.sort(rng.uniform(-1, 1, (400, 3, 5)), 2)
    x[300:] = np.sort(x[:100] + rng.normal(0, 0.01, (100, 3, 5)), 2)
    x = x.reshape(400, 15).astype(np.float32)
    n = rng.integers(80, 90, 400)
    rows = [(k, "arm", int(n[k]), [float(v) for v in x[k]], k % 3) for k in range(400)]
    points = spark.createDataFrame(rows, "episode_key bigint, embodiment string, frames bigint, sketch array<float>, batch int")
    index = history.HistoryIndex(spark, str(tmp_path / "index"))
    for b in range(3):
        index.add(points.where(f"episode_key < 300 and batch = {b}"))
    assert index.segments == [(0, 2), (2, 3)]
    opened = history.HistoryIndex.opened(spark, str(tmp_path / "index"))
    got = {(r.a, r.b) for r in opened.candidates(points.where("episode_key >= 300")).collect()}
    i, j = (v.ravel() for v in np.meshgrid(np.arange(300), np.arange(300, 400), indexing="ij"))
    ok = (np.minimum(n[i], n[j]) >= 0.8 * np.maximum(n[i], n[j]) - 1e-9) & history.within_bounds(x[i], x[j])
    want = set(zip(i[ok].tolist(), j[ok].tolist(), strict=True))
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) >= 100
