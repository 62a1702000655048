"""Attributes as known at event time (bitemporal as-of join).

An attribute row holds from ``holds_from`` on and is known from ``known_from``
on. From the later of both it competes; among competing rows the greatest
(holds_from, known_from, id) wins. The winners' change times give validity
intervals, cut at time buckets; events meet them by an equi-join on entity and
bucket with half-open containment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinelake.operators.regular_grid import finite

#: Width of a time bucket, in the unit of the times.
BUCKET = 16.0


def validity_intervals(attributes: DataFrame, event_buckets: DataFrame, bucket: float = BUCKET) -> DataFrame:
    """Intervals (entity, bucket, valid_from, valid_to, attribute_id, payload) without overlap.

    ``attributes``: entity, attribute_id, holds_from, known_from, payload;
    ``event_buckets``: the distinct (entity, bucket) that hold events. Only those
    buckets get intervals, so a far-off time costs nothing. No window spans more
    than one entity's bucket or one entity's list of buckets.
    """
    rows = (
        attributes.where(F.col("entity").isNotNull() & finite(F.col("holds_from")) & finite(F.col("known_from")))
        .select("entity", F.struct("holds_from", "known_from", "attribute_id", "payload").alias("key"), F.greatest("holds_from", "known_from").alias("since"))
        .withColumn("bucket", F.floor(F.col("since") / bucket))
    )
    best = rows.groupBy("entity", "bucket").agg(F.max("key").alias("best"))
    asked = event_buckets.select("entity", "bucket", F.lit(True).alias("asked"))
    earlier = Window.partitionBy("entity").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    by_bucket = best.join(asked, ["entity", "bucket"], "full").withColumn("carried", F.max("best").over(earlier)).where("asked")
    carried = by_bucket.where(F.col("carried").isNotNull()).select("entity", "bucket", F.col("carried").alias("key"), F.lit(float("-inf")).alias("since"))
    inside = rows.join(asked, ["entity", "bucket"], "left_semi").select("entity", "bucket", "key", "since")
    order = Window.partitionBy("entity", "bucket").orderBy("since", "key")
    leaders = (
        inside.unionByName(carried)
        .withColumn("before", F.max("key").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        .where(F.col("before").isNull() | (F.col("key") > F.col("before")))
        .withColumn("until", F.coalesce(F.lead("since").over(order), F.lit(float("inf"))))
        .where(F.col("since") < F.col("until"))
    )
    return leaders.select("entity", "bucket", F.col("since").alias("valid_from"), F.col("until").alias("valid_to"), F.col("key.attribute_id").alias("attribute_id"), F.col("key.payload").alias("payload"))


def attributes_known_at(events: DataFrame, attributes: DataFrame, bucket: float = BUCKET) -> DataFrame:
    """Each event (entity, event_id, event_time) with the attribute known and valid then.

    Events without any such attribute, without a finite time or with a null
    entity give no row; repeated events and attributes count once; ties in both
    times go to the greater id. A row that becomes known late but holds from an
    earlier time never overrides one that holds from later on. Extra columns are
    ignored; empty tables give an empty result.
    """
    events = events.where(F.col("entity").isNotNull() & finite(F.col("event_time"))).select("entity", "event_id", "event_time")
    events = events.withColumn("bucket", F.floor(F.col("event_time") / bucket))
    asked = events.select("entity", "bucket").distinct()
    held = validity_intervals(attributes, asked, bucket)
    once = events.dropDuplicates(["entity", "event_id", "event_time"])
    return once.join(held, ["entity", "bucket"]).where((F.col("valid_from") <= F.col("event_time")) & (F.col("event_time") < F.col("valid_to"))).select("entity", "event_id", "event_time", "attribute_id", "payload")


def annotation_at_steps(steps: DataFrame, annotations: DataFrame, bucket: float = BUCKET) -> DataFrame:
    """The annotation known and holding at each step: episode_key, frame_index, annotation_id, content."""
    events = steps.select(F.col("episode_key").alias("entity"), F.col("frame_index").alias("event_id"), F.col("step_time").alias("event_time"))
    said = annotations.where(F.col("content").rlike(r"(?U)\S")).select(
        F.col("episode_key").alias("entity"), "annotation_id", F.col("annotation_id").alias("attribute_id"), F.col("said_at").alias("holds_from"), F.col("known_at").alias("known_from"), F.col("content").alias("payload")
    )
    found = attributes_known_at(events, said, bucket)
    return found.select(F.col("entity").alias("episode_key"), F.col("event_id").alias("frame_index"), F.col("attribute_id").alias("annotation_id"), F.col("payload").alias("content"))
