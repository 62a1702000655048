"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelake.llm.tokens import VOCABULARY, token_counts
from kinelake.session import cut_lineage

#: Places on the line of hashes at which a fractional repetition may end before texts are counted one by one.
BUCKETS = 65_536


def water_fill(weights: dict[str, float], capacity: dict[str, float], total: float) -> dict[str, float]:
    """Shares of ``total`` in proportion to the weights, none above its capacity.

    Sources at their capacity are clamped and the excess goes to the others in
    proportion to their weights, until nothing exceeds. If all are clamped the
    sum stays below the total.
    """
    out = {k: 0.0 for k in weights}
    open_ = {k for k, w in weights.items() if w > 0 and capacity.get(k, 0) > 0}
    left = float(total)
    while open_:
        scale = left / sum(weights[k] for k in open_)
        over = {k for k in open_ if weights[k] * scale >= capacity[k]}
        if not over:
            out.update({k: weights[k] * scale for k in open_})
            break
        for k in over:
            out[k] = float(capacity[k])
            left -= capacity[k]
        open_ -= over
    return out


def source_key(source: Column) -> Column:
    flat = F.lower(F.regexp_replace(source, r"(?U)^\s+|\s+$", ""))
    return F.when(flat != "", flat)


def mix(lengths: DataFrame, targets: DataFrame, share_of_total: float = 0.5, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """Draw texts so that each source reaches its share: (draws, report).

    ``lengths``: doc_id, source, text_key, n_tokens; ``targets``: source,
    target_share, max_repeats. The total is ``share_of_total`` of all documents'
    tokens. Equal texts (``text_key``) are one text, held by their smallest doc_id
    among the sources with a target, so no text is drawn more than its source's
    ``max_repeats`` times however often it was delivered. A source is repeated
    whole ``floor(epochs)`` times; its last, fractional repetition takes texts in
    the order of a seeded hash up to the tokens left, to the nearest text.

    Draws: doc_id, source, n_tokens, copies (>= 1). Report, one row per target
    source: source, target_share, max_repeats, tokens (available), drawn_tokens,
    actual_share (of all drawn), epochs. Sources without a target, null sources
    and texts without tokens are not drawn; a null or repeated target counts as
    none or once; targets without documents draw nothing and their weight goes to
    the others; empty tables give an empty draw.
    """
    wanted = targets.select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats").where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    kinds = {r["source"]: r for r in wanted.collect()}  # the table of targets is fixed and small
    rows = cut_lineage(lengths.where(F.col("doc_id").isNotNull()).select("doc_id", source_key(F.col("source")).alias("source"), "text_key", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens")).groupBy("doc_id").agg(F.max(F.struct("source", "text_key", "n_tokens")).alias("d")).select("doc_id", "d.*"))
    total = (rows.agg(F.sum("n_tokens")).head()[0] or 0) * share_of_total
    owned = rows.where((F.col("n_tokens") > 0) & F.col("source").isin(*kinds)) if kinds else rows.limit(0)
    texts = owned.groupBy("text_key").agg(F.min(F.struct("doc_id", "source", "n_tokens")).alias("o")).select("o.*")
    texts = texts.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(BUCKETS)))
    texts = cut_lineage(texts)
    tokens = {r["source"]: r["tokens"] for r in texts.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).collect()}
    cap = {k: float(tokens.get(k, 0)) * max(kinds[k]["max_repeats"] or 0, 0) for k in kinds}
    share = water_fill({k: float(v["target_share"] or 0) for k, v in kinds.items()}, cap, total)
    spark = lengths.sparkSession
    plan = []
    for k in kinds:
        epochs = share[k] / tokens[k] if tokens.get(k) else 0.0
        whole = int(epochs + 1e-9)
        plan.append((k, whole, max(share[k] - whole * tokens.get(k, 0), 0.0), epochs))
    steps = spark.createDataFrame(plan, "source string, whole int, left double, epochs double")
    by_bucket = texts.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("t")).withColumn("upto", F.sum("t").over(Window.partitionBy("source").orderBy("bucket")))
    # the bucket in which the fractional repetition ends
    edge = by_bucket.join(F.broadcast(steps), "source").where(F.col("upto") > F.col("left")).groupBy("source").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("t")).alias("before"))).alias("e"))
    limits = steps.join(edge, "source", "left").select("source", "whole", "left", F.coalesce(F.col("e.bucket"), F.lit(BUCKETS)).alias("edge"), F.coalesce(F.col("e.before"), F.lit(0)).alias("before"))
    placed = texts.join(F.broadcast(limits), "source")
    inner = placed.where(F.col("bucket") == F.col("edge")).withColumn("upto", F.col("before") + F.sum("n_tokens").over(Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)))
    outer = placed.where(F.col("bucket") != F.col("edge")).withColumn("upto", F.when(F.col("bucket") < F.col("edge"), F.lit(0)))
    drawn = outer.unionByName(inner).withColumn("copies", F.col("whole") + F.when(F.col("upto") - F.col("n_tokens") / 2 <= F.col("left"), 1).otherwise(0))
    draws = drawn.where("copies > 0").select("doc_id", "source", "n_tokens", F.col("copies").cast("int").alias("copies"))
    got = draws.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("drawn_tokens"))
    held = texts.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    report = wanted.join(held, "source", "left").join(got, "source", "left").join(steps.select("source", "epochs"), "source", "left").na.fill(0, ["tokens", "drawn_tokens"])
    report = report.withColumn("actual_share", F.try_divide(F.col("drawn_tokens").cast("double"), F.sum("drawn_tokens").over(Window.partitionBy())))
    return draws, report.select("source", "target_share", "max_repeats", "tokens", "drawn_tokens", "actual_share", "epochs")


def mix_documents(documents: DataFrame, targets: DataFrame, share_of_total: float = 0.5, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """``mix`` for whole texts measured in tokens; equal texts have equal SHA-256."""
    counted = token_counts(documents.withColumn("text_key", F.sha2("text", 256)), vocabulary, keep=("source", "text_key"))
    return mix(counted, targets, share_of_total)


def mix_checks(draws: DataFrame, report: DataFrame, lengths: DataFrame, total: float) -> DataFrame:
    """Per target source: ``capped`` (no text beyond max_repeats) and ``met``: its tokens are its water-filled share of ``total``, to half the longest text that ``lengths`` has of it."""
    rows = {r["source"]: r for r in report.collect()}  # one row per target source, a fixed and small table
    share = water_fill({k: r["target_share"] or 0.0 for k, r in rows.items()}, {k: float(r["tokens"] * max(r["max_repeats"] or 0, 0)) for k, r in rows.items()}, total)
    wanted = draws.sparkSession.createDataFrame([(k, float(v), int(rows[k]["max_repeats"] or 0)) for k, v in share.items()], "source string, share double, most int")
    got = draws.groupBy("source").agg(F.max("copies").alias("copies"), F.sum(F.col("n_tokens") * F.col("copies")).alias("drawn"))
    longest = lengths.groupBy(source_key(F.col("source")).alias("source")).agg(F.max("n_tokens").alias("longest"))
    both = wanted.join(got, "source", "left").join(longest, "source", "left").na.fill(0, ["copies", "drawn", "longest"])
    return both.select("source", (F.col("copies") <= F.col("most")).alias("capped"), (F.abs(F.col("drawn") - F.col("share")) <= F.col("longest") / 2 + 1).alias("met"))
