"""Trajectory operators against goldens, brute force and their precedence rules."""

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinelake.functions import hashing, vectors
from kinelake.operators import asof, ledger, quality, stats
from kinelake.operators import trajectories as tr
from kinelake.plans import reference as plans

NAN, INF = float("nan"), float("inf")
STEP = "episode_key bigint, frame_index bigint, step_time double, state array<double>, action array<double>, language string, own int"
EPISODE = "episode_key bigint, source_id string, episode_id string, origin_group string, embodiment string, fps double, video string, video_offset double, video_end double, state_names array<string>, action_names array<string>, semantics_status string, success boolean, task string"


def steps(n=4, key=1, fps=20.0, **changes):
    rows = [[key, i, i / fps, [1.0, 1.0], [2.0 * i, 2.0 * i + 1], "task", 0] for i in range(n)]
    for (i, c), v in changes.get("set", {}).items():
        rows[i][c] = v
    return [tuple(r) for r in rows]


def episode(key=1, **changes):
    row = dict(episode_key=key, source_id="s", episode_id=str(key), origin_group="original:0", embodiment="robot", fps=20.0, video="v", video_offset=0.0, video_end=None, state_names=[], action_names=[], semantics_status="unknown", success=None, task="task")
    return tuple({**row, **changes}.values())


def report(spark, rows, eps, videos=(("s", "v"),)):
    got = quality.quality_report(spark.createDataFrame(rows, STEP), spark.createDataFrame(eps, EPISODE), spark.createDataFrame(list(videos), "source_id string, video string"))
    return {r.episode_key: r for r in got.collect()}


@pytest.mark.parametrize(
    ("changes", "ep", "code"),
    [
        ({(0, 4): [NAN, 0.0]}, {}, "action_non_finite"),
        ({(0, 3): [INF, 0.0]}, {}, "state_non_finite"),
        ({(1, 2): 0.0}, {}, "non_monotonic_time"),
        ({(2, 2): -1.0}, {}, "non_monotonic_time"),
        ({(2, 2): NAN}, {}, "invalid_timestamps"),
        ({(1, 5): " 　"}, {}, "missing_language"),
        ({(1, 4): None}, {}, "action_shape"),
        ({(1, 3): [1.0]}, {}, "state_shape"),
        ({}, {"video": None}, "missing_video"),
        ({}, {"video": "gone"}, "missing_video"),
        ({}, {"episode_id": "../escape"}, "unsafe_episode_id"),
        ({}, {"episode_id": "abc\n"}, "unsafe_episode_id"),
        ({}, {"fps": NAN}, "invalid_fps"),
        ({}, {"origin_group": " "}, "missing_origin_group"),
        ({}, {"state_names": ["a", "a"]}, "state_names_mismatch"),
        ({}, {"action_names": ["a"]}, "action_names_mismatch"),
    ],
)
def test_each_fault_is_named(spark, changes, ep, code):
    assert report(spark, steps(set=changes), [episode(**ep)])[1].errors == [code]


def test_unknown_success_is_not_success(spark):
    r = report(spark, steps() + steps(1, 2) + steps(3, 3, set={(2, 2): 0.2}), [episode(), episode(2, success=False), episode(3, success=True, semantics_status="verified")])
    assert r[1].errors == [] and r[1].warnings == ["action_semantics_not_deployment_verified", "success_unknown_not_assumed_expert"] and not r[1].deployment_ready and r[1].eligible_view == "interface_smoke"
    assert r[2].errors == ["too_few_steps"] and r[3].warnings == ["irregular_sample_intervals"]


def test_split_goldens(spark):
    groups = ["lab:0", "lab:1", 'q"uote', "中文组", "a/b", "x" * 300]
    got = {r.g: r.s for r in spark.createDataFrame([(g,) for g in groups], "g string").select("g", hashing.split_of(F.col("g")).alias("s")).collect()}
    for g in groups:
        text = json.dumps({"group": g, "seed": "lab-demo-v1"}, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
        want = "validation" if int(hashlib.sha256(text.encode()).hexdigest()[:8], 16) % 5 == 0 else "train"
        assert got[g] == want and hashing.object_digest({"group": g, "seed": "lab-demo-v1"}) == hashlib.sha256(text.encode()).hexdigest()
    path = spark.range(1).select(hashing.capture_id(F.lit("demo_task/episode_0000/data.json"))).head()[0]
    assert path == "xr_11f449fcb422e301"
    with pytest.raises(ValueError):
        hashing.canonical_text(NAN)


@pytest.mark.parametrize(("n", "count"), [(24, 4), (108, 12), (109, 12), (111, 12), (115, 13), (121, 13), (1, 1), (10, 2), (11, 2)])
def test_anchor_counts(spark, n, count):
    assert tr.anchors(spark.createDataFrame(steps(n), STEP)).count() == count


@pytest.mark.parametrize("most", [1, 2, 3, 5, 7, 64])
def test_thinning_matches_truncated_even_places(spark, most):
    rows = [r for k, n in enumerate((3, 57, 200, 331)) for r in steps(n, k)]
    got = {}
    for r in tr.anchors(spark.createDataFrame(rows, STEP), 3, most).collect():
        got.setdefault(r.episode_key, []).append(r.frame_index)
    for k, n in enumerate((3, 57, 200, 331)):
        a = np.unique(np.append(np.arange(0, n, 3), n - 1))
        if len(a) > most:
            a = a[np.linspace(0, len(a) - 1, most).astype(int)]
        assert sorted(got[k]) == a.tolist()


def test_chunks_never_cross_an_episode_whatever_the_blocks(spark, monkeypatch):
    rows = steps(6, 1) + steps(23, 2)
    df = spark.createDataFrame(rows, STEP)
    whole = {(r.episode_key, r.frame_index): r.chunk for r in tr.action_chunks(df).collect()}
    assert whole[1, 5] == [[10.0, 11.0]] and [len(whole[2, i]) for i in range(23)] == [min(8, 23 - i) for i in range(23)]
    real = tr.blocked
    monkeypatch.setattr(tr, "blocked", lambda d, before=0, after=0: real(d, before, after, size=5))
    assert {(r.episode_key, r.frame_index): r.chunk for r in tr.action_chunks(df).collect()} == whole
    assert all((r.dt is None) == (r.frame_index == 0) for r in tr.step_intervals(df).collect())


def test_padding_masks_and_tokens(spark):
    r = spark.range(1).select(
        vectors.zero_padded(F.array(F.array(F.lit(1.0), F.lit(2.0))), 3, F.lit(2)).alias("z"), vectors.edge_padded(F.array(F.array(F.lit(1.0))), 3).alias("e"), vectors.chunk_mask(F.lit(1), 2, F.lit(2)).alias("m"),
        vectors.byte_tokens(F.lit("é!"), 5).alias("t"), vectors.byte_tokens(F.lit("x" * 500)).alias("long"), vectors.byte_tokens(F.lit(None).cast("string"), 3).alias("none"), vectors.unverified_names("action", F.lit(2)).alias("n"),
    ).head()
    assert r.z == [[1, 2], [0, 0], [0, 0]] and r.e == [[1], [1], [1]] and r.m == [[True, True], [False, False]]
    assert r.t == [0xC3 + 1, 0xA9 + 1, 0x22, 0, 0] and r.long == [0x79] * 192 and r.none == [0, 0, 0] and r.n == ["unverified_action_0", "unverified_action_1"]


def test_asof_never_sees_the_future_whatever_the_blocks(spark):
    rng = random.Random(3)
    rec = [(rng.choice("ab"), round(rng.uniform(0, 90), 1)) for _ in range(150)] + [("a", None), (None, 3.0)]
    ev = [(rng.choice("abc"), i, round(rng.uniform(-5, 95), 1)) for i in range(200)] + [("a", 900, None), (None, 901, 5.0)]
    for block in (3.0, 500.0):
        got = {r.i: r.found for r in asof.asof_backward(spark.createDataFrame(ev, "k string, i int, at double"), spark.createDataFrame(rec, "k string, t double"), ["k"], "at", "t", block).collect()}
        for k, i, at in ev:
            want = None if at is None or k is None else max((t for rk, t in rec if rk == k and t is not None and t <= at), default=None)
            assert got[i] == want


def test_frames_align_backward_with_reasons(spark):
    st = spark.createDataFrame(steps(4, 1) + steps(4, 2) + steps(4, 3), STEP)
    eps = spark.createDataFrame([episode(1), episode(2, video="w", video_offset=10.0, video_end=10.1), episode(3, video="late")], EPISODE)
    fr = spark.createDataFrame([("s", "v", t) for t in (0.0, 0.05, 0.1000005)] + [("s", "w", t) for t in (9.99, 10.0, 10.06)] + [("s", "late", 0.06)], "source_id string, video string, pts double")
    got = {(r.episode_key, r.frame_index): (r.video_pts, r.reason) for r in asof.align_frames(st, eps, fr).collect()}
    assert [got[1, i] for i in range(4)] == [(0.0, None), (0.05, None), (0.1000005, None), (0.1000005, None)]
    assert [got[2, i][1] for i in range(4)] == [None, None, None, "boundary"] and got[2, 1][0] == 10.0
    assert [got[3, i][1] for i in range(4)] == ["no_past_frame", "no_past_frame", None, "stale"]


def test_frames_of_one_time_fail_the_episodes_that_hold_them(spark):
    st = spark.createDataFrame([r for k in (1, 2, 3, 4) for r in steps(4, k)], STEP)
    eps = spark.createDataFrame([episode(1), episode(2, video_offset=1.0), episode(3, video="again"), episode(4, video="after")], EPISODE)
    fr = [(i + 100 * o, "s", "v", o + i / 20) for o in (0, 1) for i in range(4)] + [(50, "s", "v", 0.1)]  # 0.1 twice: in the first episode's part of the video only
    fr += [(200 + i, "s", "again", i / 20) for i in range(4)] * 2  # redelivered
    fr += [(300 + i, "s", "after", min(i, 4) / 20) for i in range(6)]  # 0.2 twice, after the last target
    got = {k: set() for k in (1, 2, 3, 4)}
    for r in asof.align_frames(st, eps, spark.createDataFrame(fr, "frame_id bigint, source_id string, video string, pts double")).collect():
        got[r.episode_key].add(r.reason)
    assert got == {1: {"non_increasing_pts"}, 2: {None}, 3: {None}, 4: {None}}


def test_causal_language(spark):
    st = spark.createDataFrame([(1, i, t, [1.0], [1.0], "task", 0) for i, t in enumerate((-1.0, 1.0, 5.0))], STEP)
    notes = spark.createDataFrame([(1, 1, 0.0, "grasp"), (2, 1, 5.0, "release"), (3, 1, 5.0, "later row of the same moment")], "annotation_id bigint, episode_key bigint, said_at double, content string")
    got = [r.instruction for r in asof.language_at(st, spark.createDataFrame([episode()], EPISODE), notes).orderBy("frame_index").collect()]
    assert got == ["task", "task | grasp", "task | release"]


def test_statistics_come_from_training_episodes_only(spark):
    rows = steps(4, 1) + [(2, i, 0.0, [1.0, 1.0], [1e9, 1e9], "x", 0) for i in range(4)]
    eps = [(1, "s", "1", "train"), (2, "s", "2", "validation"), (3, "t", "3", "validation")]
    st, ep = spark.createDataFrame(rows + [(3, 0, 0.0, [1.0], [1.0], "x", 0)], STEP), spark.createDataFrame(eps, "episode_key bigint, source_id string, episode_id string, split string")
    w = {(r.episode_key, r.anchor_index): r for r in stats.training_windows(st, ep, 8, 10, 64).collect()}
    assert set(w) == {(1, 0), (1, 3), (2, 0), (2, 3)}
    a = np.array([[2 * i, 2 * i + 1] for i in range(4)], float)
    np.testing.assert_allclose(np.array(w[1, 0].actions)[:4], ((a - a.mean(0)) / a.std(0)).astype(np.float32), rtol=1e-6)
    assert np.array(w[1, 0].actions)[4:].sum() == 0 and sum(m[0] for m in w[1, 3].action_mask) == 1
    assert w[1, 0].state == [0.0, 0.0]
    status = {r.source_id: r.view_status for r in stats.view_status(ep, spark.createDataFrame([("s",), ("t",), ("u",)], "source_id string")).collect()}
    assert status == {"s": "interface_smoke_only", "t": "no_train_split", "u": "no_eligible_episodes"}
    s = {(r.kind, r.dim): (r["mean"], r["std"]) for r in stats.channel_stats(st.where("episode_key = 1").withColumn("source_id", F.lit("s")), "source_id", ["state", "action"]).collect()}
    assert s["action", 0][0] == 3.0 and s["action", 1][0] == 4.0 and s["state", 0] == (1.0, 1e-6)


COMPACT = "ord bigint, source_id string, episode_key bigint, quality_ok boolean, contract string, fingerprint string, media_ok boolean"


def test_ledger_precedence(spark):
    rows = [
        (1, "a", 1, False, "x", "f1", True), (2, "a", 2, True, "x", "f1", False), (3, "a", 3, True, "x", "f1", True), (4, "b", 4, True, "x", "f1", True), (5, "b", 5, True, "x", "f1", False), (6, "b", 6, True, "x", "f2", True),
    ]
    got = {r.episode_key: (r.outcome, r.stage, r.duplicate_of) for r in ledger.decide(spark.createDataFrame(rows, COMPACT)).collect()}
    assert got == {1: ("quarantined", "quality", None), 2: ("quarantined", "media", None), 3: ("accepted", None, None), 4: ("duplicate", None, 3), 5: ("duplicate", None, 3), 6: ("accepted", None, None)}


def test_ledger_window_equals_fold(spark):
    rng = random.Random(8)
    for mixed in (False, True):
        rows = [(i, rng.choice("ab"), i, rng.random() > 0.2, rng.choice("xy") if mixed else "x", f"f{rng.randint(0, 9)}", rng.random() > 0.3) for i in range(60)]
        got = {r.episode_key: (r.outcome, r.stage, r.duplicate_of) for r in ledger.decide(spark.createDataFrame(rows, COMPACT)).collect()}
        names = [c.split()[0] for c in COMPACT.split(", ")]
        want = {r["episode_key"]: (r["outcome"], r["stage"], r["duplicate_of"]) for r in ledger.fold(dict(zip(names, x, strict=True)) for x in rows)}
        assert got == want


def test_ledger_settles_contracts_across_sources(spark):
    """Many sources of mixed contracts whose first accepted episodes depend on one another's."""
    rng = random.Random(21)
    rows = [(i, rng.choice([None, *"abcdefgh"]), i, rng.random() > 0.1, rng.choice("xyz"), f"f{rng.randint(0, 60)}", rng.random() > 0.3) for i in range(400)]
    got = {r.episode_key: (r.outcome, r.stage, r.duplicate_of) for r in ledger.decide(spark.createDataFrame(rows, COMPACT)).collect()}
    names = [c.split()[0] for c in COMPACT.split(", ")]
    want = {r["episode_key"]: (r["outcome"], r["stage"], r["duplicate_of"]) for r in ledger.fold(dict(zip(names, x, strict=True)) for x in rows)}
    assert got == want and {"contract", "media"} <= {x[1] for x in got.values()}


def write_tables(spark, folder, names, frames):
    """Data tables of one source with an episode of four steps per entry of ``names`` (its revision's state names)."""
    n = len(names)
    rows = [(*r[:3], [float(k), 1.0], *r[4:], "s") for k in range(1, n + 1) for r in steps(4, k)]
    spark.createDataFrame(rows, STEP + ", source_id string").write.parquet(f"{folder}/steps.parquet")
    eps = [(*episode(k), f"r{k}") for k in range(1, n + 1)]
    spark.createDataFrame(eps, EPISODE + ", revision string").drop("state_names", "action_names", "semantics_status").write.parquet(f"{folder}/episodes.parquet")
    src = [("s", f"r{k}", k, names[k - 1], None, "verified") for k in range(1, n + 1)]
    spark.createDataFrame(src, "source_id string, revision string, batch_no int, state_names array<string>, action_names array<string>, semantics_status string").write.parquet(f"{folder}/sources.parquet")
    spark.createDataFrame(frames, "frame_id bigint, source_id string, video string, pts double").write.parquet(f"{folder}/frames.parquet")
    return str(folder)


def test_registered_ledger_holds_a_source_to_its_channel_names(spark, tmp_path):
    d = write_tables(spark, tmp_path, [None, ["x", "y"], []], [(i, "s", "v", i / 20) for i in range(4)])
    got = {r.episode_key: (r.outcome, r.stage) for r in plans.episode_ledger(spark, d).collect()}
    assert got == {1: ("accepted", None), 2: ("quarantined", "contract"), 3: ("accepted", None)}


def test_registered_ledger_refuses_frames_of_one_time(spark, tmp_path):
    d = write_tables(spark, tmp_path, [None], [(i, "s", "v", i / 20) for i in range(4)] + [(9, "s", "v", 0.05)])
    assert [(r.outcome, r.stage) for r in plans.episode_ledger(spark, d).collect()] == [("quarantined", "media")]


def test_fingerprint_ignores_words_and_keeps_zeros_apart(spark):
    rows = steps(3, 1) + [(*r[:5], "other words", 0) for r in steps(3, 2)] + steps(3, 3, set={(0, 4): [-0.0, 1.0]}) + steps(3, 4, set={(0, 3): None}) + steps(3, 5, set={(0, 3): [NAN, 1.0]}) + steps(3, 6)
    eps = [episode(k, source_id=f"s{k}", embodiment="other" if k == 6 else "robot") for k in range(1, 7)]
    got = {r.episode_key: r.fingerprint for r in ledger.trajectory_fingerprints(spark.createDataFrame(rows, STEP), spark.createDataFrame(eps, EPISODE)).collect()}
    assert got[1] == got[2] and len(set(got.values())) == 5


def test_row_addresses(spark):
    rows = [("s", "train", e, a) for e in ("10", "2", "9") for a in (0, 10)] + [("s", "validation", "1", 0)]
    got = tr.window_addresses(spark.createDataFrame(rows, "source_id string, split string, episode_id string, anchor_index bigint")).collect()
    assert sorted((r.row_address, r.episode_id, r.anchor_index) for r in got if r.split == "train") == [(i, *x) for i, x in enumerate([("10", 0), ("10", 10), ("2", 0), ("2", 10), ("9", 0), ("9", 10)])]


def test_empty_tables_give_empty_results(spark):
    st, ep = spark.createDataFrame([], STEP), spark.createDataFrame([], EPISODE)
    assert quality.quality_report(st, ep).count() == 0 and tr.anchors(st).count() == 0 and tr.action_chunks(st).count() == 0 and tr.episode_summary(st).count() == 0
    assert ledger.decide(spark.createDataFrame([], COMPACT)).count() == 0 and quality.parse_report(st, ep.withColumn("length", F.lit(1))).count() == 0


def test_masked_error(spark):
    df = spark.createDataFrame([(1.0, 3.0, True), (5.0, 5.0, True), (9.0, 0.0, False)], "p double, t double, m boolean")
    assert stats.masked_error(df, "p", "t", "m").head()[0] == 2.0
    assert stats.masked_error(df.where("not m"), "p", "t", "m").head()[0] is None
