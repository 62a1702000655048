"""The episode gate: every failing check by name, and warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelake.functions.hashing import safe_id
from kinelake.functions.vectors import all_finite, is_blank, is_finite
from kinelake.operators.trajectories import step_intervals


def _codes(*checks: tuple[Column, str]) -> Column:
    listed = F.array(*(F.when(F.coalesce(c, F.lit(False)), code) for c, code in checks))
    return F.filter(listed, lambda x: x.isNotNull())


def quality_report(steps: DataFrame, episodes: DataFrame, frames: DataFrame | None = None) -> DataFrame:
    """errors and warnings of each episode that has steps, in the order of the checks.

    ``episodes``: episode_key, episode_id, fps, origin_group, success, video,
    state_names, action_names, semantics_status. ``frames`` lists the videos that
    exist (source_id, video); without it a video only has to be named. All checks
    are reported, except that order is tested only for finite times and values only
    for a consistent shape. ``eligible_view`` is set where there are no errors.
    """
    rows = step_intervals(steps.select("episode_key", "frame_index", "step_time", "state", "action", "language")).join(episodes.select("episode_key", "fps"), "episode_key")
    period = F.try_divide(F.lit(1.0), F.col("fps"))
    good_fps = is_finite(F.col("fps")) & (F.col("fps") > 0)
    per = rows.groupBy("episode_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_or(~is_finite(F.col("step_time"))).alias("bad_time"),
        F.bool_or(F.col("dt") <= 0).alias("not_rising"),
        F.bool_or(good_fps & (F.abs(F.col("dt") - period) > 0.15 * period)).alias("irregular"),
        F.bool_or(is_blank(F.col("language"))).alias("blank"),
        *(
            agg
            for k in ("state", "action")
            for agg in (F.min(F.size(k)).alias(f"{k}_least"), F.max(F.size(k)).alias(f"{k}_most"), F.count(k).alias(f"{k}_n"), F.bool_or(~all_finite(F.col(k))).alias(f"{k}_infinite"))
        ),
    )
    e = per.join(episodes, "episode_key")
    if frames is not None:
        there = frames.select("source_id", "video").where("source_id is not null and video is not null").distinct().withColumn("there", F.lit(True))
        e = e.join(there, ["source_id", "video"], "left")
    else:
        e = e.withColumn("there", F.col("video").isNotNull())
    shape = {k: (F.col(f"{k}_least") != F.col(f"{k}_most")) | (F.col(f"{k}_most") <= 0) | (F.col(f"{k}_n") != F.col("n")) for k in ("state", "action")}
    names = {k: (F.size(f"{k}_names") > 0) & ((F.size(f"{k}_names") != F.col(f"{k}_most")) | (F.size(F.array_distinct(f"{k}_names")) != F.size(f"{k}_names"))) for k in ("state", "action")}
    errors = _codes(
        (~safe_id(F.col("episode_id")), "unsafe_episode_id"),
        (F.col("n") < 2, "too_few_steps"),
        (~good_fps, "invalid_fps"),
        (F.col("bad_time"), "invalid_timestamps"),
        (~F.col("bad_time") & F.col("not_rising"), "non_monotonic_time"),
        *((c, code) for k in ("state", "action") for c, code in ((shape[k], f"{k}_shape"), (~F.coalesce(shape[k], F.lit(False)) & F.col(f"{k}_infinite"), f"{k}_non_finite"))),
        *((names[k], f"{k}_names_mismatch") for k in ("state", "action")),
        (F.col("blank"), "missing_language"),
        (is_blank(F.col("origin_group")), "missing_origin_group"),
        (F.col("there").isNull() | ~F.col("there"), "missing_video"),
    )
    warnings = _codes(
        (~F.coalesce(F.col("semantics_status") == "verified", F.lit(False)), "action_semantics_not_deployment_verified"),
        (F.col("success").isNull(), "success_unknown_not_assumed_expert"),
        (F.col("irregular"), "irregular_sample_intervals"),
    )
    return e.select("episode_key", errors.alias("errors"), warnings.alias("warnings"), F.col("n").alias("frames"), F.col("state_most").alias("state_dim"), F.col("action_most").alias("action_dim")).withColumn(
        "eligible_view", F.when(F.size("errors") == 0, "interface_smoke")
    ).withColumn("deployment_ready", F.lit(False))


def parse_report(steps: DataFrame, episodes: DataFrame) -> DataFrame:
    """Structure of each listed episode: rows, contiguous (indices are 0..n-1), length_ok, reason of refusal."""
    per = steps.groupBy("episode_key").agg(F.count(F.lit(1)).alias("rows"), F.min("frame_index").alias("lo"), F.max("frame_index").alias("hi"), F.count_distinct("frame_index").alias("distinct"))
    e = episodes.select("episode_key", "length").join(per, "episode_key", "left").na.fill(0, ["rows"])
    contiguous = F.coalesce((F.col("lo") == 0) & (F.col("hi") == F.col("rows") - 1) & (F.col("distinct") == F.col("rows")), F.lit(False))
    agrees = F.coalesce(F.col("rows") == F.col("length"), F.lit(False))
    reason = F.when(F.col("rows") == 0, "episode_boundary").when(~agrees, "length_disagrees").when(~contiguous, "index_not_contiguous")
    return e.select("episode_key", "rows", contiguous.alias("contiguous"), agrees.alias("length_ok"), reason.alias("reason"))


def contract_signatures(reports: DataFrame, episodes: DataFrame) -> DataFrame:
    """How many different contracts (fps, embodiment, widths, channel names) a source's episodes have."""
    both = reports.select("episode_key", "state_dim", "action_dim").join(episodes, "episode_key")
    sig = F.to_json(F.struct("fps", "embodiment", "state_dim", "action_dim", "state_names", "action_names"))
    return both.groupBy("source_id").agg(F.count_distinct(sig).alias("signatures"))
