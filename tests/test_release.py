"""Whole runs over files: registration, releases, capture import, export, reading, streams, command line."""

import json
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kinelake import cli, export, importer, register, release
from kinelake.dataset import WindowDataset
from kinelake.functions import rules
from kinelake.sources import files, readers
from kinelake.streaming import arrivals


def lab_batch(folder: Path, extra=(), revision="v1"):
    """Eight good episodes, a duplicate and a bad one."""
    (folder / "media").mkdir(parents=True)
    (folder / "media/all.mp4").write_bytes(b"placeholder")
    names = []
    for i, name in enumerate([*map(str, range(8)), "duplicate", "bad", *extra]):
        j = 0 if name == "duplicate" else i
        steps = [{"timestamp": t / 20, "state": [j, t / 20], "action": [j + t / 10, 1.0], "language": "fixture task"} for t in range(20)]
        if name == "bad":
            steps[2]["timestamp"] = 0
        doc = {"episode_id": name, "origin_group": f"lab:{name}", "fps": 20, "video": "media/all.mp4", "success": None, "steps": steps}
        (folder / f"{name}.json").write_text(json.dumps(doc))
        names.append(f"{name}.json")
    spec = {"id": "fixture", "label": "Fixture", "format": "lab_json_v1", "revision": revision, "embodiment": "robot", "origin_namespace": "lab", "license": "test", "environment": "test", "collection": "test", "semantics_status": "unknown", "episode_files": names}
    (folder / "source.json").write_text(json.dumps(spec))
    return folder / "source.json"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lab")
    lock = base / "lock.json"
    register.register_local(base / "in", lab_batch(base / "in"), base / "data", lock)
    manifest, reused = release.run(spark, lock, base / "data")
    assert not reused
    return base, lock, manifest


def test_release_counts_and_reuse(spark, built):
    base, lock, m = built
    assert (m["accepted_episodes"], m["duplicate_episodes"], m["quarantined_episodes"], m["numeric_frames"]) == (8, 1, 1, 160)
    assert m["training_windows"] == 8 * 3
    again, reused = release.run(spark, lock, base / "data")
    assert reused and again == m
    folder = base / "data/releases" / m["release_id"]
    q = spark.read.parquet(str(folder / "quarantine")).collect()
    assert [(r.episode_id, r.stage, r.reasons) for r in q] == [("bad", "quality", ["non_monotonic_time"])]
    d = spark.read.parquet(str(folder / "duplicates")).head()
    assert (d.episode_id, d.same_numeric_trajectory_as) == ("duplicate", "fixture:0")
    assert files.read_json(base / "data/latest.json")["release_id"] == m["release_id"]


def test_new_revision_keeps_old_splits(spark, built, tmp_path):
    base, _, m = built
    lock = tmp_path / "lock2.json"
    register.register_local(tmp_path / "in", lab_batch(tmp_path / "in", ["new"], "v2"), base / "data", lock)
    m2, _ = release.run(spark, lock, base / "data")
    assert m2["accepted_episodes"] == 9 and m2["release_id"] != m["release_id"]
    split = [{r.episode_id: r.split for r in spark.read.parquet(str(base / "data/releases" / x["release_id"] / "episodes")).collect()} for x in (m, m2)]
    assert all(split[1][k] == v for k, v in split[0].items())
    release.verify_release(base / "data/releases" / m["release_id"])


def test_windows_read_back_and_denormalize(spark, built):
    base, _, m = built
    folder = base / "data/releases" / m["release_id"]
    data = WindowDataset(spark, folder, "fixture", "train")
    other = WindowDataset(spark, folder, "fixture", "validation")
    assert len(data) + len(other) == 24
    row = data[0]
    assert row == data[-len(data)] and row["anchor_index"] == 0
    raw = spark.read.parquet(str(folder / "canonical")).where(F.col("episode_id") == row["episode_id"]).orderBy("frame_index").limit(8).collect()
    back = data.denormalize(row["actions"])
    assert all(abs(a - b) < 1e-6 for x, r in zip(back, raw) for a, b in zip(x, r.action))
    for bad in (len(data), -len(data) - 1):
        with pytest.raises(IndexError):
            data[bad]
    with pytest.raises(ValueError):
        WindowDataset(spark, folder, "fixture", "test")


def test_export_replays_raw_and_refuses_changes(spark, built, tmp_path):
    base, _, m = built
    folder = base / "data/releases" / m["release_id"]
    receipt = export.export(spark, folder, base / "data/raw", "fixture", "train", tmp_path / "out")
    frames = spark.read.parquet(str(tmp_path / "out/data"))
    assert frames.count() == receipt["frames"] == 20 * receipt["episodes"]
    w = export.reader_windows(frames).where("frame_index = 18").head()
    assert w.action_is_pad == [False, False] + [True] * 6 and len(w.actions) == 8
    with pytest.raises(FileExistsError):
        export.export(spark, folder, base / "data/raw", "fixture", "train", tmp_path / "out")
    raw = base / "data/raw/fixture/v1/3.json"
    keep = raw.read_bytes()
    raw.write_bytes(keep + b" ")
    with pytest.raises(ValueError, match="changed"):
        export.plan_export(spark, folder, base / "data/raw", "fixture", "train")
    raw.write_bytes(keep)


def test_corruption_and_collisions_are_refused(built, tmp_path):
    base, lock, m = built
    with pytest.raises(ValueError, match="revision"):
        register.register_local(tmp_path / "in", lab_batch(tmp_path / "in", ["other"]), base / "data", tmp_path / "lock.json")
    (tmp_path / "r").mkdir()
    (tmp_path / "r/data").write_text("ok")
    files.save_json(tmp_path / "r/manifest.json", {"output_sha256": {"data": files.sha256_file(tmp_path / "r/data")}})
    release.verify_release(tmp_path / "r")
    (tmp_path / "r/data").write_text("broken")
    with pytest.raises(ValueError, match="corrupted"):
        release.verify_release(tmp_path / "r")


def test_files_stay_inside_and_match(tmp_path, spark):
    (tmp_path / "link").symlink_to(tmp_path.parent)
    for bad in ("../x", "link/x"):
        with pytest.raises(ValueError):
            files.inside(tmp_path, bad)
    (tmp_path / "x").write_bytes(b"corrupt")
    with pytest.raises(ValueError):
        files.obtain("", tmp_path / "x", 100, "a" * 64, True)
    with pytest.raises(FileNotFoundError):
        files.obtain("", tmp_path / "none", 100, None, True)
    with pytest.raises(ValueError):
        files.obtain("", tmp_path / "x", 3)
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a").write_bytes(b"1")
    seen = files.digests(spark, tmp_path / "d").withColumn("path", F.regexp_extract("path", "([^/]+)$", 1))
    lock = spark.createDataFrame([("a", 1, files.sha256_file(tmp_path / "d/a")), ("b", 1, "0" * 64)], "path string, bytes bigint, sha256 string")
    assert [tuple(r) for r in files.lock_mismatches(seen, lock).collect()] == [("b", "absent")]


@pytest.mark.parametrize("change", [{"id": "CON"}, {"id": "a b"}, {"revision": ".."}, {"revision": "v1."}, {"revision": ""}, {"license": None}, {"files": [{"path": "../x", "bytes": 1, "sha256": "0" * 64}]}])
def test_locks_are_checked(change):
    spec = {"id": "x", "origin_namespace": "o", "revision": "r", "license": "test", "files": []}
    release.check_lock({"sources": [spec]})
    with pytest.raises(ValueError):
        release.check_lock({"sources": [{**spec, **change}]})
    with pytest.raises(ValueError):
        release.check_lock({"sources": [spec, {**spec, "id": "X"}]})


@pytest.mark.parametrize("change", [{"view": "action_bc"}, {"normalize": "none"}, {"horizon": 0}, {"split_seed": ""}, {"action_rate": "x"}])
def test_unsupported_recipes_are_refused(change):
    with pytest.raises(ValueError):
        release.full_recipe(change)


def captures(folder: Path, faults=()):
    for e in range(3):
        at = folder / f"demo_task/episode_{e:04d}"
        (at / "colors").mkdir(parents=True)
        data = []
        for f in range(12):
            (at / f"colors/{f}.png").write_bytes(b"png")
            data.append({"idx": f, "colors": {"color_0": f"colors/{f}.png"}, "timestamp_ns": 1000 + f * 50_000_000, "states": {"left_arm": {"qpos": [e, f / 10]}}, "actions": {"left_arm": {"qpos": [e + 0.1, f / 10 + 0.2]}}})
        doc = {"info": {"image": {"fps": 20}}, "text": {"goal": "pick"}, "result": "ok" if e else "bad", "data": data}
        if e == 1:
            if "gap" in faults:
                data[5]["idx"] = 50
            if "width" in faults:
                data[5]["states"]["left_arm"]["qpos"] = [1.0]
            if "goal" in faults:
                doc["text"]["goal"] = " "
            if "image" in faults:
                (at / "colors/3.png").unlink()
            if "time" in faults:
                data[5]["timestamp_ns"] += 10_000_000
        (at / "data.json").write_text(json.dumps(doc))
    mapping = {
        "source": {"id": "xr", "revision": "r1", "label": "x", "embodiment": "robot", "origin_namespace": "xr", "license": "test", "environment": "lab", "collection": "teleop"}, "camera": "color_0",
        "timing": {"mode": "measured_timestamp", "path": "timestamp_ns", "scale_to_seconds": 1e-9, "clock_id": "c"} if "time" in faults or "measured" in faults else {"mode": "nominal_index"},
        "state_fields": [{"path": "states.left_arm.qpos", "names": ["a", "b"], "unit": "rad"}], "action_fields": [{"path": "actions.left_arm.qpos", "names": ["a", "b"], "unit": "rad"}],
        "action_contract": {"kind": "absolute"}, "result_map": {"ok": True, "bad": False},
    }
    (folder.parent / "mapping.json").write_text(json.dumps(mapping))
    return folder.parent / "mapping.json"


def test_captures_become_a_release(spark, tmp_path):
    mapping = captures(tmp_path / "in", ("measured",))
    receipt = importer.import_captures(spark, tmp_path / "in", mapping, tmp_path / "batch")
    assert [e["episode_id"] for e in receipt["episodes"]][0] == "xr_11f449fcb422e301" and [e["success"] for e in receipt["episodes"]] == [False, True, True]
    assert (tmp_path / "batch/original/demo_task/episode_0001/data.json").read_bytes() == (tmp_path / "in/demo_task/episode_0001/data.json").read_bytes()
    register.register_local(tmp_path / "batch", tmp_path / "batch/source.json", tmp_path / "data", tmp_path / "lock.json")
    m, _ = release.run(spark, tmp_path / "lock.json", tmp_path / "data")
    assert m["accepted_episodes"] == 3 and m["numeric_frames"] == 36
    with pytest.raises(FileExistsError):
        importer.import_captures(spark, tmp_path / "in", mapping, tmp_path / "batch")


@pytest.mark.parametrize("fault", ["gap", "width", "goal", "image", "time"])
def test_one_bad_capture_refuses_the_batch(spark, tmp_path, fault):
    mapping = captures(tmp_path / "in", (fault,))
    with pytest.raises(ValueError):
        importer.import_captures(spark, tmp_path / "in", mapping, tmp_path / "batch")
    assert not (tmp_path / "batch").exists() and not list(tmp_path.glob(".staging-*"))


def columnar_source(root: Path, version: int):
    feats = {"observation.state": {"shape": [2], "names": ["a", "b"]}, "action": {"shape": [2], "names": {"x": 1}}}
    info = {"codebase_version": f"v{version}.0", "fps": 20, "chunks_size": 2, "features": feats}
    info |= {"data_path": "data/{episode_chunk:03d}/{episode_index:06d}.parquet", "video_path": "videos/{video_key}/{episode_index}.mp4"} if version == 2 else {"data_path": "data/{chunk_index:03d}/{file_index:03d}.parquet", "video_path": "videos/{video_key}/{chunk_index}-{file_index}.mp4"}
    paths = []

    def put(rel, write):
        (root / rel).parent.mkdir(parents=True, exist_ok=True)
        write(root / rel)
        paths.append(rel)

    def rows(e, n=5):
        return [{"observation.state": [float(e), float(i)], "action": [1.0, 2.0], "timestamp": i / 20, "frame_index": i, "episode_index": e, "task_index": 0 if e != 2 else 9, "language_persistent": [{"timestamp": 0.1, "content": "now"}]} for i in range(n)]

    put("meta/info.json", lambda p: p.write_text(json.dumps(info)))
    if version == 2:
        put("meta/tasks.jsonl", lambda p: p.write_text('{"task_index": 0, "task": "do"}\n\n'))
        put("meta/episodes.jsonl", lambda p: p.write_text("\n".join(json.dumps({"episode_index": e, "length": 5 if e != 1 else 7}) for e in range(4))))
        for e in range(4):
            put(info["data_path"].format(episode_chunk=e // 2, episode_index=e), lambda p, e=e: pq.write_table(pa.Table.from_pylist(rows(e)), p))
            put(info["video_path"].format(video_key="cam", episode_index=e), lambda p: p.write_bytes(b"v"))
    else:
        put("meta/tasks.parquet", lambda p: pq.write_table(pa.Table.from_pylist([{"task_index": 0, "task": "do"}]), p))
        meta = [{"episode_index": e, "length": 5 if e != 1 else 7, "data/chunk_index": 0, "data/file_index": 0, "videos/cam/chunk_index": 0, "videos/cam/file_index": 0, "videos/cam/from_timestamp": e * 1.0, "videos/cam/to_timestamp": e + 1.0} for e in range(4)]
        put("meta/episodes/chunk-000/file-000.parquet", lambda p: pq.write_table(pa.Table.from_pylist(meta[:2]), p))
        put("meta/episodes/chunk-000/file-001.parquet", lambda p: pq.write_table(pa.Table.from_pylist(meta[2:]), p))
        put("data/000/000.parquet", lambda p: pq.write_table(pa.Table.from_pylist([r for e in range(4) for r in rows(e)]), p))
        put("videos/cam/0-0.mp4", lambda p: p.write_bytes(b"v"))
    return {"id": "src", "revision": "r", "format": f"lerobot_v{version}", "embodiment": "robot", "origin_namespace": "ns", "camera": "cam", "license": "x", "episodes": [0, 1, 2, 3, 77], "files": [{"path": p, "bytes": 0, "sha256": "0" * 64} for p in paths]}


@pytest.mark.parametrize("version", [2, 3])
def test_columnar_sources(spark, tmp_path, version):
    spec = columnar_source(tmp_path / "src/r", version)
    s = readers.read_source(spark, spec, tmp_path)
    assert sorted(r.episode_id for r in s.episodes.collect()) == ["0", "3"]
    assert {r.episode_id: r.reasons[0] for r in s.refused.collect()} == {"1": "episode length disagrees with metadata", "2": "unresolved task_index", "77": "episode not in metadata"}
    words = [r.language for r in s.steps.where("episode_id = '3'").orderBy("frame_index").collect()]
    assert words == ["do", "do", "do | now", "do | now", "do | now"]
    e = s.episodes.where("episode_id = '3'").head()
    assert e.state_names == ["a", "b"] and e.action_names == [] and e.origin_group == "ns:3" and e.video_offset == (0.0 if version == 2 else 3.0)
    with pytest.raises(ValueError):
        readers.read_source(spark, {**spec, "format": f"lerobot_v{5 - version}"}, tmp_path)
    with pytest.raises(ValueError):
        readers.read_source(spark, {**spec, "format": "hdf5"}, tmp_path)


def test_lab_reader_refuses_single_files(spark, tmp_path):
    root = tmp_path / "lab/r"
    root.mkdir(parents=True)
    good = {"episode_id": "a", "origin_group": "g", "fps": 20, "video": None, "steps": [{"timestamp": 0, "state": [1], "action": [1], "language": "x"}]}
    (root / "good.json").write_text(json.dumps(good))
    (root / "broken.json").write_text("{")
    (root / "ragged.json").write_text(json.dumps({**good, "episode_id": "b", "steps": good["steps"] + [{"timestamp": 1, "state": [1, 2], "action": [1], "language": "x"}]}))
    names = ["good.json", "broken.json", "ragged.json", "unlisted.json"]
    spec = {"id": "lab", "revision": "r", "format": "lab_json_v1", "embodiment": "e", "episode_files": names, "files": [{"path": n} for n in names[:3]]}
    s = readers.read_source(spark, spec, tmp_path)
    assert [r.episode_id for r in s.episodes.collect()] == ["a"] and s.steps.count() == 1
    assert {r.episode_id for r in s.refused.collect()} == set(names[1:])


def test_streams_add_up(spark, tmp_path):
    import datetime as dt

    at = dt.datetime(2026, 1, 1, tzinfo=dt.UTC)
    schema = "episode_key bigint, origin_group string, received_at timestamp"
    folder = tmp_path / "in"
    for part, keys in enumerate(([1, 2, 3], [3, 4])):
        spark.createDataFrame([(k, f"g{k}", at) for k in keys], schema).coalesce(1).write.mode("append").parquet(str(folder))
        stream = arrivals.split_arrivals(arrivals.read_arrivals(spark, str(folder), spark.createDataFrame([], schema).schema))
        arrivals.drain(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
        assert spark.read.parquet(str(tmp_path / "out")).count() == (3, 4)[part]
    steps = spark.createDataFrame([(1, 0, 0.0, [1.0], [1.0], "x"), (1, 1, float("nan"), [1.0], [1.0], "x"), (1, 2, 0.0, None, [1.0], "x"), (1, 3, 0.0, [1.0], [1.0], " ")], "episode_key bigint, frame_index bigint, step_time double, state array<double>, action array<double>, language string")
    assert [r.fault for r in arrivals.step_faults(steps).orderBy("frame_index").collect()] == ["invalid_timestamps", "state_non_finite", "missing_language"]


def test_command_line_verifies(built, capsys):
    base, _, m = built
    assert cli.main(["verify", str(base / "data/releases" / m["release_id"])]) == 0
    assert json.loads(capsys.readouterr().out)["release_id"] == m["release_id"]
    with pytest.raises(SystemExit):
        cli.main(["export-lerobot", "--release", "r", "--raw-root", "x", "--source", "s", "--output", "o", "--split", "test"])


def test_rules_judge_documents_and_columns_alike(spark):
    names = ["a-b_1", "", "a b", "CON", "com7", "console", "x\n", "é", None]
    want = [True, False, False, False, False, True, False, False, False]
    assert [not rules.broken({"sources": [{"id": n}]}, rules.LOCK[:1]) for n in names] == want
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").select("i", rules.matches(F.col("n"), rules.NAME).alias("ok")).orderBy("i").collect()
    assert [r.ok for r in rows] == want
    paths = {"a/b.json": True, "../a": False, "a/../b": False, "/a": False, "a//b": False, "a\\b": False, "..a/b..": True}
    assert {p: not rules.broken({"sources": [{"files": [{"path": p}]}]}, rules.LOCK[4:5]) for p in paths} == paths
    assert rules.values_at({"a": []}, "a[+].b") == [None] and rules.values_at({"a": []}, "a[].b") == []


def test_digests_and_copies_of_many_files(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"in/{i % 2}").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"in/{i % 2}/{i} x.bin").write_bytes(bytes([i]) * 3_000_000 * i)
    seen = files.digests(spark, tmp_path / "in")
    assert {r.path: (r.bytes, r.sha256) for r in seen.collect()} == {p.relative_to(tmp_path / "in").as_posix(): (p.stat().st_size, files.sha256_file(p)) for p in (tmp_path / "in").rglob("*.bin")}
    files.copied(seen, tmp_path / "in", tmp_path / "out")
    assert files.digests(spark, tmp_path / "out").exceptAll(seen).count() == 0 and files.digests(spark, tmp_path / "none").count() == 0
