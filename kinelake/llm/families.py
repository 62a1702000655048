"""Splits that keep related records together: connected components and proportional hash ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelake.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph by alternating large-star and small-star.

    ``edges``: u, v (bigint). Returned: node, component (the smallest node of its
    component) for every node that has an edge; a self-loop names a lone node.
    Null ends are ignored, repeated edges count once, no edges give no rows.

    Large-star links each node's greater neighbours to the smallest node of its
    neighbourhood, small-star its smaller ones and itself. Minima come from map-side
    aggregation and are written before they meet the edges, so both sides of that
    join are plain shuffles and AQE can split a hot node's; no neighbourhood is
    gathered. Rounds go on until nothing changes, about log(nodes) of them.
    """
    edges = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull()).select(F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v"))
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    current = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _fingerprint(current)
    while True:
        both = current.union(current.select("v", "u"))
        low = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        down = cut_lineage(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        least = cut_lineage(down.groupBy("u").agg(F.min("v").alias("m")))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()
        current = cut_lineage(small)
        now = _fingerprint(current)
        if now == mark:
            break
        mark = now
    return nodes.join(current.groupBy("u").agg(F.min("v").alias("v")).withColumnRenamed("u", "node"), "node", "left").select("node", F.coalesce("v", "node").alias("component"))


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
    return tuple(r)


def related_records(records: DataFrame, key: str, entities: list[Column], links: list[str] | None = None) -> DataFrame:
    """Edges between records that share any entity or name each other.

    A shared entity gives a star around its smallest record, found by map-side
    minima, never all pairs. ``links`` are columns that hold another record's key;
    only keys that occur count. Every record has at least a self-loop.
    """
    once = records.where(F.col(key).isNotNull())
    parts = [once.select(F.col(key).alias("u"), F.col(key).alias("v"))]
    for entity in entities:
        held = once.select(F.col(key).alias("u"), entity.alias("entity")).where(F.col("entity").isNotNull())
        least = cut_lineage(held.groupBy("entity").agg(F.min("u").alias("v")))  # written, so that AQE can split a hot entity's join
        parts.append(held.join(least, "entity").select("u", "v"))
    known = once.select(F.col(key).alias("v")).distinct()
    for link in links or []:
        parts.append(once.select(F.col(key).alias("u"), F.col(link).alias("v")).where(F.col("v").isNotNull()).join(known, "v", "left_semi").select("u", "v"))
    edges = parts[0]
    for p in parts[1:]:
        edges = edges.unionByName(p)
    return edges


def assign_splits(components: DataFrame, shares: dict[str, float], seed: str = "split-v1") -> DataFrame:
    """Give each component a split: its hash, as a number in [0, 1), falls into one of the shares' ranges."""
    total = sum(shares.values())
    place = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(seed), F.col("component").cast("string")), 256), 1, 12), 16, 10).cast("double") / float(16**12)
    column, edge = None, 0.0
    for name, share in shares.items():
        edge += share / total
        column = F.when(place < edge, name) if column is None else column.when(place < edge, name)
    return components.withColumn("split", column.otherwise(list(shares)[-1]))


def group_key(group: Column) -> Column:
    """A group's name without case, outer blanks, `_` versus `-`, and leading zeros of its last number; blank is null."""
    flat = F.regexp_replace(F.translate(F.lower(F.regexp_replace(group, r"(?U)^\s+|\s+$", "")), "_", "-"), r"(?<![0-9])0+(?=[0-9]+$)", "")
    return F.when(flat != "", flat)


def split_name(split: Column) -> Column:
    flat = F.lower(F.regexp_replace(split, r"(?U)\s+", ""))
    return F.when(flat == "val", "validation").when(flat != "", flat)


SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}


def episode_families(episodes: DataFrame) -> DataFrame:
    """episode_key, recorded (the split as delivered, cleaned), component, split (assigned 80/10/10).

    Episodes are related by their normalized origin_group or by derived_from, and
    so on through chains. Null or blank groups relate nothing; redelivered
    episodes count once; a null key gives no row; extra columns are ignored.
    """
    once = episodes.where(F.col("episode_key").isNotNull()).groupBy("episode_key").agg(F.min(F.struct("origin_group", "derived_from", "split")).alias("e")).select("episode_key", "e.*")
    once = once.select("episode_key", "derived_from", group_key(F.col("origin_group")).alias("group_key"), split_name(F.col("split")).alias("recorded"))
    families = connected_components(related_records(once, "episode_key", [F.col("group_key")], ["derived_from"]))
    named = once.select("episode_key", "recorded").join(families.withColumnRenamed("node", "episode_key"), "episode_key")
    return assign_splits(named, SHARES)


def torn_families(episodes: DataFrame) -> DataFrame:
    """Every member of a family whose recorded splits differ: family_key, episode_key."""
    named = episode_families(episodes)
    torn = named.groupBy("component").agg(F.min("recorded").alias("a"), F.max("recorded").alias("b")).where("a <> b").select("component")
    return named.join(torn, "component", "left_semi").select(F.col("component").alias("family_key"), "episode_key")
