"""Steps and episodes: cleaning, blocks for windows, summaries, anchors and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelake.session import cut_lineage

#: Rows of an episode that one window task handles; longer episodes are cut with overlap.
BLOCK = 4096


def once(df: DataFrame, *keys: str) -> DataFrame:
    """Rows delivered again count once; rows with a null key are left out."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df.dropDuplicates(list(keys))


def blocked(df: DataFrame, before: int = 0, after: int = 0, order: str = "frame_index", size: int = BLOCK) -> DataFrame:
    """Rows by block of ``order``, also standing in a neighbouring block that needs them as context.

    A window over (episode, block) then sees ``before`` rows back and ``after``
    rows ahead of every row that the block owns (``own``), so an episode of any
    length spreads over many tasks.
    """
    o = F.col(order)
    parts = F.sequence(F.floor(F.greatest(o - after, F.least(o, F.lit(0))) / size), F.floor((o + before) / size))
    return df.withColumn("block", F.explode(parts)).withColumn("own", F.floor(o / size) == F.col("block"))


def block_window(order: str = "frame_index") -> object:
    return Window.partitionBy("episode_key", "block").orderBy(order)


def step_intervals(steps: DataFrame) -> DataFrame:
    """Each step with ``dt``, the time since the step before (null for the first)."""
    rows = blocked(steps, before=1)
    return rows.withColumn("dt", F.col("step_time") - F.lag("step_time").over(block_window())).where("own").drop("own", "block")


def episode_lengths(steps: DataFrame) -> DataFrame:
    return steps.groupBy("episode_key").agg(F.count(F.lit(1)).alias("frames"))


def episode_summary(steps: DataFrame) -> DataFrame:
    """frames, duration_seconds, task_first, task_last, state_dim, action_dim of each episode."""
    return steps.groupBy("episode_key").agg(
        F.count(F.lit(1)).alias("frames"),
        (F.max_by("step_time", "frame_index") - F.min_by("step_time", "frame_index")).alias("duration_seconds"),
        F.min_by("language", "frame_index").alias("task_first"),
        F.max_by("language", "frame_index").alias("task_last"),
        F.max(F.size("state")).alias("state_dim"),
        F.max(F.size("action")).alias("action_dim"),
    )


def rebased(steps: DataFrame) -> DataFrame:
    """Each step's time since its episode's first step."""
    first = steps.groupBy("episode_key").agg(F.min_by("step_time", "frame_index").alias("start"))
    return steps.join(first, "episode_key").withColumn("rebased_time", F.col("step_time") - F.col("start")).drop("start")


def regular_cadence(steps: DataFrame, episodes: DataFrame) -> DataFrame:
    """Whether each episode's times are frame_index / fps within a microsecond, and its fps a whole number."""
    both = steps.select("episode_key", "frame_index", "step_time").join(episodes.select("episode_key", "fps"), "episode_key")
    ok = F.coalesce(F.abs(F.col("step_time") - F.try_divide(F.col("frame_index").cast("double"), F.col("fps"))) <= 1e-6, F.lit(False))
    whole = F.coalesce(F.abs(F.col("fps") - F.rint("fps")) <= 1e-9, F.lit(False))
    return both.groupBy("episode_key").agg(F.bool_and(ok).alias("regular"), F.bool_and(whole).alias("whole_fps"))


def anchors(steps: DataFrame, stride: int = 10, most: int | None = 64) -> DataFrame:
    """Every ``stride``-th step and the last one, thinned to ``most`` evenly spread ones.

    Adds ``frames`` and ``ordinal`` (the anchor's place before thinning). Thinning
    keeps the places trunc(i * (N-1) / (most-1)) of N anchors, the last for certain.
    """
    n = episode_lengths(steps)
    rows = steps.join(n, "episode_key")
    last = F.col("frames") - 1
    rows = rows.where((F.col("frame_index") % stride == 0) | (F.col("frame_index") == last))
    # ordinals follow from the index: no window is needed
    rows = rows.withColumn("ordinal", F.ceil(F.col("frame_index") / stride))
    if most is None:
        return rows
    total = F.ceil(last / stride) + 1
    return rows.where((total <= most) | _kept(F.col("ordinal"), total, most))


def _kept(k: Column, total: Column, most: int) -> Column:
    if most == 1:
        return k == 0
    step = (total - 1).cast("double") / (most - 1)
    places = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.when(i == most - 1, total - 1).otherwise(F.floor(i * step)))
    return F.array_contains(places, k)


def action_chunks(steps: DataFrame, horizon: int = 8) -> DataFrame:
    """Each step with ``chunk``: its action and the following ones of its episode, at most ``horizon``; null actions are skipped."""
    rows = blocked(steps, after=horizon - 1)
    ahead = block_window().rowsBetween(0, horizon - 1)
    return rows.withColumn("chunk", F.collect_list("action").over(ahead)).where("own").drop("own", "block")


def anchor_windows(steps: DataFrame, horizon: int = 8, stride: int = 10, most: int = 64) -> DataFrame:
    """Each anchor's row with ``chunk``: the actions of frame_index to frame_index + horizon - 1 that its episode has; null actions are skipped.

    A frame knows from its index and its episode's length which anchors it serves, so
    frames beyond every anchor's horizon leave before the one shuffle, by episode and anchor.
    """
    f, last = F.col("frame_index"), F.col("frames") - 1
    reach = F.sequence(F.greatest(F.ceil((f - horizon + 1) / stride), F.lit(0).cast("bigint")), F.floor(f / stride))
    reach = F.when(F.floor(f / stride) >= F.greatest(F.ceil((f - horizon + 1) / stride), F.lit(0).cast("bigint")), reach).otherwise(F.array().cast("array<bigint>"))
    served = F.array_distinct(F.concat(F.transform(reach, lambda k: k * stride), F.when(f == last, F.array(last)).otherwise(F.array().cast("array<bigint>"))))
    total = F.ceil(last / stride) + 1
    kept = F.filter(served, lambda a: (total <= most) | _kept(F.ceil(a / stride), total, most))
    rows = steps.join(episode_lengths(steps), "episode_key").withColumn("anchor", F.explode(kept))
    own = F.struct(*(c for c in steps.columns if c != "episode_key"))
    held = F.array_sort(F.collect_list(F.struct(f.alias("at"), F.col("action").alias("action"))))  # at most `horizon`
    got = rows.groupBy("episode_key", "anchor").agg(F.max(F.when(f == F.col("anchor"), own)).alias("own"), held.alias("held")).where("own is not null")
    chunk = F.filter(F.transform("held", lambda h: h["action"]), lambda a: a.isNotNull())
    return got.select("episode_key", "own.*", chunk.alias("chunk"))


def window_addresses(windows: DataFrame) -> DataFrame:
    """A window's global number within its source and split: by episode name, then anchor.

    Episodes' counts are range-partitioned by name and summed in two levels, within a
    range and over the ranges, so a source with most of the episodes is no single task.
    """
    keys = ["source_id", "split"]
    sizes = windows.groupBy(*keys, "episode_id").agg(F.count(F.lit(1)).alias("n"))
    ranged = cut_lineage(sizes.repartitionByRange(*keys, "episode_id").withColumn("part", F.spark_partition_id()))
    ahead = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = ranged.groupBy(*keys, "part").agg(F.sum("n").alias("n")).withColumn("offset", ahead(Window.partitionBy(*keys).orderBy("part"))).drop("n")  # a row per range
    starts = ranged.withColumn("start", ahead(Window.partitionBy(*keys, "part").orderBy("episode_id"))).join(parts, [*keys, "part"])
    starts = starts.select(*keys, "episode_id", (F.col("start") + F.col("offset")).alias("start"))
    within = F.row_number().over(Window.partitionBy(*keys, "episode_id").orderBy("anchor_index")) - 1
    return windows.withColumn("within", within).join(starts, [*keys, "episode_id"]).withColumn("row_address", F.col("start") + F.col("within")).drop("start", "within")
