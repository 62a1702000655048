"""Training-only statistics and normalized windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.functions.vectors import chunk_mask, zero_padded, zscore
from kinelake.operators.trajectories import anchor_windows

#: The least standard deviation a channel is divided by.
FLOOR = 1e-6


def channel_stats(vectors: DataFrame, by: str, kinds: list[str]) -> DataFrame:
    """mean, population std (at least ``FLOOR``) and count per ``by``, kind and dim, over every row."""
    parts = None
    for kind in kinds:
        long = vectors.select(by, F.lit(kind).alias("kind"), F.posexplode(kind).alias("dim", "v"))
        parts = long if parts is None else parts.unionByName(long)
    return parts.groupBy(by, "kind", "dim").agg(F.avg("v").alias("mean"), F.greatest(F.stddev_pop("v"), F.lit(FLOOR)).alias("std"), F.count("v").alias("count"))


def stats_arrays(stats: DataFrame, by: str) -> DataFrame:
    """One row per ``by`` with state_mean, state_std, action_mean, action_std as arrays in channel order."""
    cells = F.array_sort(F.collect_list(F.struct("dim", "mean", "std")))  # one entry per channel
    rows = stats.groupBy(by, "kind").agg(cells.alias("c"))
    picked = [F.max(F.when(F.col("kind") == k, F.col(f"c.{p}"))).alias(f"{k}_{p}") for k in ("state", "action") for p in ("mean", "std")]
    return rows.groupBy(by).agg(*picked)


def training_windows(steps: DataFrame, episodes: DataFrame, horizon: int = 8, stride: int = 10, most: int = 64) -> DataFrame:
    """Normalized, masked action windows of accepted episodes.

    ``steps``: all steps of the accepted episodes; ``episodes``: episode_key,
    source_id, episode_id, split. Statistics come from every frame of a source's
    training episodes and serve both splits; sources without one give no windows.
    Chunks are normalized first and padded with zeros afterwards.
    """
    known = steps.select("episode_key", "frame_index", "step_time", "state", "action", "language").join(episodes.select("episode_key", "source_id", "episode_id", "split"), "episode_key")
    stats = stats_arrays(channel_stats(known.where("split = 'train'"), "source_id", ["state", "action"]), "source_id")
    w = anchor_windows(known, horizon, stride, most).join(stats, "source_id")
    norm = F.transform("chunk", lambda a: zscore(a, F.col("action_mean"), F.col("action_std")))
    width = F.size("action")
    return w.select(
        "source_id", "split", "episode_key", "episode_id", F.col("frame_index").alias("anchor_index"), F.col("step_time").alias("timestamp"), "language",
        zscore(F.col("state"), F.col("state_mean"), F.col("state_std")).cast("array<float>").alias("state"),
        zero_padded(norm, horizon, width).cast("array<array<float>>").alias("actions"),
        chunk_mask(F.size("chunk"), horizon, width).alias("action_mask"),
    )


def view_status(episodes: DataFrame, sources: DataFrame) -> DataFrame:
    """accepted, train episodes and the view status of every source, also of those without accepted episodes."""
    per = episodes.groupBy("source_id").agg(F.count(F.lit(1)).alias("accepted"), F.count_if(F.col("split") == "train").alias("train"))
    e = sources.select("source_id").distinct().join(per, "source_id", "left").na.fill(0, ["accepted", "train"])
    status = F.when(F.col("accepted") == 0, "no_eligible_episodes").when(F.col("train") == 0, "no_train_split").otherwise("interface_smoke_only")
    return e.select("source_id", "accepted", "train", status.alias("view_status"))


def masked_error(pairs: DataFrame, predicted: str, target: str, mask: str) -> DataFrame:
    """Mean squared error over the cells of the mask; an empty mask gives null (a caller refuses it)."""
    d = F.col(predicted) - F.col(target)
    return pairs.agg(F.try_divide(F.sum(F.when(F.col(mask), d * d)), F.count_if(F.col(mask)).cast("double")).alias("masked_mse"), F.count_if(F.col(mask)).alias("cells"))
