"""Backward as-of joins: the latest earlier record, never a later one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinelake.functions.vectors import is_finite

#: Time differences below this are round-off between clocks, in seconds.
TOLERANCE = 1e-6
BLOCK = 32.0


def asof_backward(events: DataFrame, records: DataFrame, keys: list[str], at: str, record_time: str, block: float = BLOCK) -> DataFrame:
    """Each event with ``found``: the greatest ``record_time`` <= ``at`` of its keys (null if there is none).

    Windows run within (keys, block of time); what an earlier block leaves behind
    comes from a table with one row per block, so no key is gathered in one task.
    Events with a null key or time are kept, with null; null record times never match.
    """
    rec = records.na.drop(subset=keys).where(is_finite(F.col(record_time))).select(*keys, F.col(record_time).alias("_t")).withColumn("_b", F.floor(F.col("_t") / block)).distinct()
    ev = events.withColumn("_b", F.floor(F.col(at) / block))
    ends = rec.groupBy(*keys, "_b").agg(F.max("_t").alias("_end"))
    asked = ev.where(is_finite(F.col(at))).select(*keys, "_b").distinct()
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = asked.withColumn("_asked", F.lit(True)).join(ends, [*keys, "_b"], "full").withColumn("_carried", F.max("_end").over(earlier)).where("_asked").select(*keys, "_b", "_carried")
    tagged = ev.withColumn("_k", F.lit(1)).withColumn("_at", F.col(at))
    both = tagged.unionByName(rec.select(*keys, "_b", F.lit(0).alias("_k"), F.col("_t").alias("_at"), "_t"), allowMissingColumns=True)
    order = Window.partitionBy(*keys, "_b").orderBy("_at", "_k").rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("_in", F.max("_t").over(order)).where("_k = 1").drop("_t", "_k", "_at")
    return placed.join(carried, [*keys, "_b"], "left").withColumn("found", F.when(is_finite(F.col(at)), F.coalesce("_in", "_carried"))).drop("_in", "_carried", "_b")


def repeated_times(frames: DataFrame) -> DataFrame:
    """source_id, video, pts of times that two frames of a video share; a redelivered ``frame_id`` (where there is one) is one frame."""
    if "frame_id" in frames.columns:
        frame = F.coalesce("frame_id", F.lit(-1))
        several = F.min(frame) != F.max(frame)
    else:
        several = F.count(F.lit(1)) > 1
    return frames.where(is_finite(F.col("pts"))).groupBy("source_id", "video", "pts").agg(several.alias("several")).where("several").drop("several")


def align_frames(anchors: DataFrame, episodes: DataFrame, frames: DataFrame) -> DataFrame:
    """Video time of each anchor, backward only: episode_key, frame_index, target, video_pts, age, reason.

    ``reason`` is null for a good anchor, else what fails: ``boundary`` (the target
    lies beyond the video's end), ``no_past_frame`` (none at or after the offset and
    not later than the target), ``stale`` (older than 1.5 periods) or, on all other
    anchors of the episode, ``non_increasing_pts`` (two frames between its offset and
    last target have one time). Round-off of a microsecond is allowed on each side.
    """
    media = episodes.select("episode_key", "source_id", "video", "fps", F.coalesce("video_offset", F.lit(0.0)).alias("video_offset"), "video_end")
    ev = anchors.select("episode_key", "frame_index", "step_time").join(media, "episode_key").withColumn("target", F.col("step_time") + F.col("video_offset")).withColumn("latest", F.col("target") + TOLERANCE)
    got = asof_backward(ev, frames.select("source_id", "video", "pts"), ["source_id", "video"], "latest", "pts")
    spans = ev.where(is_finite(F.col("target"))).groupBy("episode_key", "source_id", "video", "video_offset").agg(F.max("latest").alias("last"))
    inside = (F.col("pts") >= F.col("video_offset") - TOLERANCE) & (F.col("pts") <= F.col("last"))
    marked = spans.join(repeated_times(frames), ["source_id", "video"]).where(inside).select("episode_key").distinct().withColumn("repeats", F.lit(True))
    got = got.join(marked, "episode_key", "left")
    seen = F.when(F.col("found") >= F.col("video_offset") - TOLERANCE, F.col("found"))
    age = F.col("target") - seen
    reason = (
        F.when(F.col("target") >= F.col("video_end") + TOLERANCE, "boundary")
        .when(seen.isNull(), "no_past_frame")
        .when(~F.coalesce(age <= F.try_divide(F.lit(1.5), F.col("fps")), F.lit(False)), "stale")
        .when(F.col("repeats"), "non_increasing_pts")
    )
    return got.select("episode_key", "frame_index", "target", seen.alias("video_pts"), age.alias("age"), reason.alias("reason"))


def language_at(steps: DataFrame, episodes: DataFrame, annotations: DataFrame) -> DataFrame:
    """Each step's instruction: the task, with the latest annotation said until then behind a bar.

    Of annotations said at one moment the first delivered (smallest id) counts.
    """
    said = annotations.where(F.col("content").isNotNull() & is_finite(F.col("said_at")) & F.col("episode_key").isNotNull())
    first = said.groupBy("episode_key", "said_at").agg(F.min_by("content", "annotation_id").alias("content"))
    got = asof_backward(steps.select("episode_key", "frame_index", "step_time"), first, ["episode_key"], "step_time", "said_at")
    named = got.withColumnRenamed("found", "said_at").join(first, ["episode_key", "said_at"], "left").join(episodes.select("episode_key", "task"), "episode_key", "left")
    return named.select("episode_key", "frame_index", F.when(F.col("content").isNull(), F.col("task")).otherwise(F.concat(F.col("task"), F.lit(" | "), F.col("content"))).alias("instruction"))
