"""Importing XR captures: a mapping names the fields, nothing is guessed from a product.

A capture is one ``data.json`` per episode with nested records. Spark reads all of
them, flattens the mapped fields and checks names, widths, finite values, index
gaps and cadence; one bad episode refuses the whole batch. Originals are kept byte
for byte. Pictures stay files: a frame index (pts, path) takes the place of a video.
"""

from __future__ import annotations

import json
import shutil
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.functions.hashing import capture_id
from kinelake.functions.rules import ANY, Rule, require, values_at
from kinelake.functions.vectors import all_finite, is_blank, is_finite
from kinelake.sources.files import inside, publish, read_json, save_json, sha256_file

MAPPING = [
    *(Rule(f"source.{name}", ANY) for name in ("id", "revision", "embodiment", "origin_namespace", "license", "environment", "collection")),
    *(Rule(f"{kind}_fields[+].{part}", ANY, distinct) for kind in ("state", "action") for part, distinct in (("path", False), ("unit", False), ("names[+]", True))),
    Rule("camera", ANY),
    Rule("action_contract", r"(?s)(?!\{\}).+"),
    Rule("timing.mode", "nominal_index|measured_timestamp"),
]
#: What else holds for one clock, and for the status that an import may claim.
MEASURED = [Rule("timing.clock_id", ANY), Rule("timing.path", ANY)]
STATUS = [Rule("source.semantics_status", "unknown")]


def check_mapping(mapping: dict) -> None:
    """Refuse a mapping that breaks a rule; every breach is named. A status that is not given counts as unknown."""
    rules = MAPPING + (MEASURED if values_at(mapping, "timing.mode") == ["measured_timestamp"] else []) + (STATUS if "semantics_status" in mapping["source"] else [])
    require(mapping, rules, "mapping")


def _field(path: str) -> Column:
    return F.col("r." + ".".join(f"`{p}`" for p in path.split(".")))


def read_captures(spark: SparkSession, folder: Path, files: list[str], mapping: dict) -> DataFrame:
    """One row per record: rel, pos, idx, ticks, state, action, image, and the episode's goal, fps and result."""
    uris = {inside(folder, rel).as_uri().replace("file:///", "file:/"): rel for rel in files}
    raw = spark.read.option("multiLine", True).json(list(uris))
    names = spark.createDataFrame(list(uris.items()), "uri string, rel string")
    raw = raw.withColumn("uri", F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")).join(F.broadcast(names), "uri")  # as long as the batch's list
    rate = F.lit(float(mapping["fps"])) if "fps" in mapping else F.col("info.image.fps").cast("double")
    result = F.col("result").cast("string") if "result" in raw.columns else F.lit(None).cast("string")
    rows = raw.select("rel", F.col("text.goal").alias("goal"), rate.alias("fps"), result.alias("result"), F.posexplode("data").alias("pos", "r"))
    ticks = _field(mapping["timing"]["path"]).cast("double") if mapping["timing"]["mode"] == "measured_timestamp" else F.lit(None).cast("double")
    out = {}
    for kind in ("state", "action"):
        parts, good = [], F.lit(True)
        for f in mapping[f"{kind}_fields"]:
            v = _field(f["path"])
            v = v.cast("array<double>") if str(raw.select(F.explode("data").alias("r")).select(v).schema[0].dataType).startswith("Array") else F.array(v.cast("double"))
            parts.append(v)
            good = good & F.coalesce((F.size(v) == len(f["names"])) & all_finite(v), F.lit(False))
        out[kind], out[kind + "_ok"] = F.concat(*parts), good
    return rows.select("rel", "goal", "fps", "result", "pos", F.col("r.idx").cast("bigint").alias("idx"), ticks.alias("ticks"), _field("colors." + mapping["camera"]).alias("image"), *(c.alias(k) for k, c in out.items()))


def timed(rows: DataFrame, mapping: dict) -> DataFrame:
    """Records with ``step_time``: the index over the rate, or the measured clock since the first record."""
    if mapping["timing"]["mode"] == "nominal_index":
        return rows.withColumn("step_time", F.col("pos") / F.col("fps"))
    first = rows.groupBy("rel").agg(F.min_by("ticks", "pos").alias("t0"))
    scale = float(mapping["timing"]["scale_to_seconds"])
    return rows.join(first, "rel").withColumn("step_time", (F.col("ticks") - F.col("t0")) * scale).drop("t0")


def faults(rows: DataFrame, mapping: dict) -> DataFrame:
    """rel and fault of each capture that no import may accept (empty: all good)."""
    gap = F.max(F.col("idx") - F.col("pos")) != F.min(F.col("idx") - F.col("pos"))
    if mapping["timing"]["mode"] != "nominal_index":
        gap = F.lit(False)
    per = rows.groupBy("rel").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and("state_ok").alias("state_ok"), F.bool_and("action_ok").alias("action_ok"), F.coalesce(gap, F.lit(True)).alias("gap"), F.bool_or(F.col("image").isNull()).alias("no_image"),
        F.first("fps").alias("fps"), F.first("goal").alias("goal"), F.bool_and(F.coalesce(F.abs(F.col("step_time") - F.col("pos") / F.col("fps")) <= 1e-6, F.lit(False))).alias("regular"),
    )
    fault = (
        F.when(F.col("n") < 2, "fewer than two records")
        .when(~is_finite(F.col("fps")) | (F.col("fps") <= 0), "invalid frequency")
        .when(F.col("gap"), "index has gaps")
        .when(~F.col("regular"), "irregular timing; nothing is resampled silently")
        .when(is_blank(F.col("goal")), "no task goal")
        .when(~F.col("state_ok") | ~F.col("action_ok"), "a field has another width or values that are not finite")
        .when(F.col("no_image"), "a record lacks its image")
    )
    return per.select("rel", fault.alias("fault")).where("fault is not null")


def import_captures(spark: SparkSession, source_dir: str | Path, mapping_path: str | Path, output: str | Path) -> dict:
    """Convert a folder of captures to a described lab_json_v1 batch; all or nothing. Returns the receipt."""
    source, target = Path(source_dir).resolve(), Path(output).resolve()
    mapping = read_json(Path(mapping_path))
    check_mapping(mapping)
    if target.exists():
        raise FileExistsError(f"{target} exists: use a new folder or revision")
    if source == target or source in target.parents or target in source.parents:
        raise ValueError("source and output must lie apart")
    files = mapping.get("episode_files") or sorted(p.relative_to(source).as_posix() for p in source.rglob("data.json"))
    if not files:
        raise ValueError("no captures found")
    receipt: dict = {}

    def build(work: Path) -> None:
        originals = []
        for p in sorted(source.rglob("*")):
            if p.is_symlink():
                raise ValueError(f"symbolic link in the capture: {p.name}")
            if p.is_file():
                copy = work / "original" / p.relative_to(source)
                copy.parent.mkdir(parents=True, exist_ok=True)
                shutil.copy2(p, copy)
                originals.append({"path": copy.relative_to(work).as_posix(), "bytes": copy.stat().st_size, "sha256": sha256_file(copy)})
        snapshot = work / "original"
        rows = timed(read_captures(spark, snapshot, files, mapping), mapping).persist()
        try:
            bad = faults(rows, mapping).limit(5).collect()
            if bad:
                raise ValueError("; ".join(f"{r['rel']}: {r['fault']}" for r in bad))
            steps = F.array_sort(F.collect_list(F.struct("pos", F.col("step_time").alias("timestamp"), "state", "action", "image")))  # one capture is one file
            eps = rows.groupBy("rel").agg(F.first("goal").alias("goal"), F.first("fps").alias("fps"), F.first("result").alias("result"), steps.alias("steps")).withColumn("episode_id", capture_id(F.col("rel"))).orderBy("rel")
            save_json(work / "mapping.json", mapping)
            mapped = sha256_file(work / "mapping.json")
            listed, told = [], []
            for r in eps.toLocalIterator():
                images = [inside((snapshot / r["rel"]).parent, s["image"]) for s in r["steps"]]
                if snapshot.resolve() not in images[0].parents or not all(p.is_file() for p in images):
                    raise ValueError(f"{r['rel']}: an image is missing")
                success = mapping.get("result_map", {}).get(r["result"]) if r["result"] is not None else None
                if success is not None and not isinstance(success, bool):
                    raise ValueError("result_map values must be true or false")
                index = f"media/{r['episode_id']}.frames.json"
                save_json(work / index, [{"pts": s["timestamp"], "image": p.relative_to(work.resolve()).as_posix()} for s, p in zip(r["steps"], images, strict=True)])
                group = mapping.get("origin_groups", {}).get(r["rel"], f"{mapping['source']['origin_namespace']}:{r['rel']}")
                basis = "nominal_index_over_fps" if mapping["timing"]["mode"] == "nominal_index" else "measured_field_since_first_record"
                rel = f"episodes/{r['episode_id']}.json"
                save_json(work / rel, {
                    "episode_id": r["episode_id"], "origin_group": group, "fps": r["fps"], "video": index, "success": success, "timestamp_basis": basis, "provenance": {"original_json": f"original/{r['rel']}", "mapping_sha256": mapped},
                    "steps": [{"timestamp": s["timestamp"], "state": s["state"], "action": s["action"], "language": r["goal"]} for s in r["steps"]],
                })
                listed.append(rel)
                told.append({"episode_id": r["episode_id"], "original_json": f"original/{r['rel']}", "records": len(r["steps"]), "fps": r["fps"], "success": success, "origin_group": group})
        finally:
            rows.unpersist()
        # fixed values: the receipt's keys and schema, the names of the batch's files
        receipt.update({"schema": "unitree_import_receipt_v1", "mapping_sha256": mapped, "original_files": originals, "episodes": told, "deployment_ready": False})
        save_json(work / "conversion.json", receipt)
        names = {f"{k}_names": [n for f in mapping[f"{k}_fields"] for n in f["names"]] for k in ("state", "action")}
        save_json(work / "source.json", dict(mapping["source"], format="lab_json_v1", semantics_status="unknown", episode_files=listed, extra_files=[o["path"] for o in originals] + ["mapping.json", "conversion.json"], action_contract=mapping["action_contract"], **names))

    publish(target, build)
    return json.loads((target / "conversion.json").read_text(encoding="utf-8"))
