"""Arriving steps and episodes as streams: what needs no whole release is answered per arrival.

Splits and alignments that only look backward do not depend on later data, so
they may run incrementally; statistics and ledgers are rebuilt per release.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kinelake.functions.hashing import DEFAULT_SEED, split_of
from kinelake.functions.vectors import all_finite, is_blank, is_finite


def read_arrivals(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 64) -> DataFrame:
    """A folder of Parquet files that grows, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def split_arrivals(episodes: DataFrame, seed: str = DEFAULT_SEED, late: str = "7 days") -> DataFrame:
    """Each arriving episode once with its split; what comes again within ``late`` is left out by its key."""
    return episodes.withWatermark("received_at", late).dropDuplicatesWithinWatermark(["episode_key"]).withColumn("split", split_of(F.col("origin_group"), seed))


def step_faults(steps: DataFrame) -> DataFrame:
    """Steps that would refuse their episode, as they arrive: episode_key, frame_index, fault."""
    fault = (
        F.when(~is_finite(F.col("step_time")), "invalid_timestamps")
        .when(~F.coalesce(all_finite(F.col("state")), F.lit(False)), "state_non_finite")
        .when(~F.coalesce(all_finite(F.col("action")), F.lit(False)), "action_non_finite")
        .when(is_blank(F.col("language")), "missing_language")
    )
    return steps.select("episode_key", "frame_index", fault.alias("fault")).where("fault is not null")


def arrivals_per_window(steps: DataFrame, width: str = "1 hour", late: str = "7 days") -> DataFrame:
    """Steps and sources per window of receipt, with late data up to ``late``."""
    return steps.withWatermark("received_at", late).groupBy(F.window("received_at", width), "source_id").agg(F.count(F.lit(1)).alias("steps")).select(F.col("window.start").alias("start"), "source_id", "steps")


def drain(stream: DataFrame, target: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything that has arrived and stop; run again, it goes on from its checkpoint."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
