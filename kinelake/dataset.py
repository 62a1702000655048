"""Reading training windows of a verified release by number."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.operators.trajectories import window_addresses
from kinelake.release import verify_release
from kinelake.session import cut_lineage


class WindowDataset:
    """A map-style view of one source's split: ``len``, ``[i]`` (also negative), and the whole as a DataFrame.

    Windows are numbered by episode name and anchor. An access filters the split's
    partition by number; for training, take ``frame`` and stream it.
    """

    def __init__(self, spark: SparkSession, release: str | Path, source: str, split: str = "train"):
        manifest = verify_release(release)
        if source not in {s["source_id"] for s in manifest["sources"]}:
            raise ValueError(f"unknown source: {source}")
        if split not in ("train", "validation"):
            raise ValueError("the split is train or validation")
        self.release_id = manifest["release_id"]
        views = Path(release) / "views"
        rows = spark.read.parquet(str(views)).where((F.col("source_id") == source) & (F.col("split") == split))
        self.frame: DataFrame = cut_lineage(window_addresses(rows))
        self._length = self.frame.count()
        stats = spark.read.parquet(str(Path(release) / "statistics")).where((F.col("source_id") == source) & (F.col("kind") == "action")).orderBy("dim").collect()  # one row per channel
        self.action_mean, self.action_std = [r["mean"] for r in stats], [r["std"] for r in stats]

    def __len__(self) -> int:
        return self._length

    def __getitem__(self, index: int) -> dict:
        at = index + self._length if index < 0 else index
        if not 0 <= at < self._length:
            raise IndexError(index)
        return self.frame.where(F.col("row_address") == at).head().asDict()

    def denormalize(self, actions: list[list[float]]) -> list[list[float]]:
        return [[x * s + m for x, s, m in zip(a, self.action_std, self.action_mean, strict=True)] for a in actions]
