"""Queries over the problem tables for the operators of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.llm import families, history, language, mixing, nearest_time, packing, tokens
from kinelake.session import cut_lineage, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return nearest_time.frames_for_steps(table(spark, d, "steps"), table(spark, d, "episodes"), table(spark, d, "frames"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    found = history.repeated_episodes(table(spark, d, "steps"), table(spark, d, "episodes"), table(spark, d, "sources"))
    return found.select("episode_key_a", "episode_key_b")


def p2_new_batch(spark: SparkSession, d: str) -> DataFrame:
    """The last third of the deliveries as one new batch against the stored index of the ones before (added in two batches): its links."""
    return history.replayed_batch(table(spark, d, "steps"), table(spark, d, "episodes"), table(spark, d, "sources"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return families.torn_families(table(spark, d, "episodes"))


def p6_splits(spark: SparkSession, d: str) -> DataFrame:
    return families.episode_families(table(spark, d, "episodes")).select("episode_key", F.col("component").alias("family_key"), "split")


def p8_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"))


def p9_draws(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_documents(table(spark, d, "documents"), table(spark, d, "mixture_targets"))[0]


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_documents(table(spark, d, "documents"), table(spark, d, "mixture_targets"))[1]


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """Whether every document is packed whole and every sequence within its capacity."""
    counted = cut_lineage(tokens.token_counts(table(spark, d, "documents")))
    return packing.pack_checks(counted, cut_lineage(packing.pack(counted)))


def p9_checks(spark: SparkSession, d: str) -> DataFrame:
    """Whether every source reaches its water-filled share and keeps to its repeats."""
    documents, targets = table(spark, d, "documents"), table(spark, d, "mixture_targets")
    draws, report = mixing.mix_documents(documents, targets)
    lengths = cut_lineage(tokens.token_counts(documents.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.struct("source", "text")).alias("d")).select("doc_id", "d.*"), keep=("source",)))
    total = lengths.agg(F.sum("n_tokens")).head()[0] or 0
    return mixing.mix_checks(cut_lineage(draws), report, lengths, total * 0.5)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return language.relabelled(table(spark, d, "documents"))


def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every segment of every document with its confidence, whether its label was right or not."""
    return language.document_segments(table(spark, d, "documents")).select("doc_id", "segment_no", "language", "confidence")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p2_found, p2_new_batch, p6_found, p6_splits, p8_pack, p8_checks, p9_draws, p9_report, p9_checks, p10_found, p10_segments)
}

EPISODE_FAMILIES = r"""
WITH RECURSIVE e AS (
  SELECT episode_key, any_value(derived_from) AS derived_from,
         any_value(nullif(regexp_replace(replace(lower(trim(origin_group)), '_', '-'), '(^|[^0-9])0+([0-9]+)$', '\1\2'), '')) AS g,
         any_value(nullif(CASE lower(trim(split)) WHEN 'val' THEN 'validation' ELSE lower(trim(split)) END, '')) AS s
  FROM episodes GROUP BY 1),
edge AS (
  SELECT a.episode_key AS u, b.m AS v FROM e a JOIN (SELECT g, min(episode_key) AS m FROM e WHERE g IS NOT NULL GROUP BY 1) b ON a.g = b.g
  UNION SELECT a.episode_key, b.episode_key FROM e a JOIN e b ON a.derived_from = b.episode_key),
link AS (SELECT u, v FROM edge UNION SELECT v, u FROM edge),
reach AS (
  SELECT episode_key AS a, episode_key AS b FROM e
  UNION SELECT r.a, l.v FROM reach r JOIN link l ON r.b = l.u),
fam AS (SELECT a AS episode_key, min(b) AS family_key FROM reach GROUP BY 1)
"""

# every pair of like length of one embodiment, frame against frame: the longest common subsequence is the longest rising run of partners
REPEATS = """
WITH RECURSIVE e AS (
  SELECT episode_key, any_value(x.embodiment) AS embodiment, min(coalesce(batch_no, 2147483647)) AS batch_no, any_value(lim) AS lim
  FROM episodes x LEFT JOIN sources USING (source_id, revision) LEFT JOIN (SELECT source_id, max(joint_limit) AS lim FROM sources GROUP BY 1) USING (source_id)
  WHERE x.embodiment IS NOT NULL GROUP BY 1),
f AS MATERIALIZED (
  SELECT episode_key, embodiment, lim * 0.001 * (1 + 1e-9) AS tol, n, row_number() OVER (PARTITION BY episode_key ORDER BY frame_index) AS i,
         list_transform(list_concat(list_resize(coalesce(state, []), 16), list_resize(coalesce(action, []), 16)), lambda v: CASE WHEN v IS NULL THEN 1e300 WHEN isnan(v) THEN 2e300 WHEN isinf(v) THEN sign(v) * 3e300 ELSE v END) AS v
  FROM (SELECT DISTINCT ON (episode_key, frame_index) * FROM steps WHERE episode_key IS NOT NULL AND frame_index IS NOT NULL)
  JOIN (SELECT episode_key, count(DISTINCT frame_index) AS n FROM steps GROUP BY 1) USING (episode_key) JOIN e USING (episode_key) WHERE lim > 0),
cell AS (
  SELECT a.episode_key AS a, b.episode_key AS b, any_value(greatest(a.n, b.n)) AS most, a.i, list([b.i] ORDER BY b.i DESC) AS js
  FROM f a JOIN f b ON a.embodiment = b.embodiment AND a.episode_key < b.episode_key AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9
    AND a.v[1] BETWEEN b.v[1] - b.tol AND b.v[1] + b.tol AND abs(a.v[2] - b.v[2]) <= a.tol
  WHERE list_bool_and(list_transform(list_zip(a.v, b.v), lambda p: abs(p[1] - p[2]) <= a.tol)) GROUP BY a.episode_key, b.episode_key, a.i),
run AS (
  SELECT a, b, any_value(most) AS most, list_reduce(flatten(list(js ORDER BY i)), lambda tails, j: list_concat(list_concat(list_filter(tails, lambda t: t < j[1]), j), list_filter(tails, lambda t: t >= j[1])[2:])) AS tails
  FROM cell GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM run WHERE len(tails) >= 0.8 * most - 1e-9)
"""

ORACLES: dict[str, str] = {
    "p2_found": REPEATS + """,
reach AS (SELECT a AS x, b AS y FROM link UNION SELECT b, a FROM link UNION SELECT r.x, l.y FROM reach r JOIN (SELECT a AS x, b AS y FROM link UNION SELECT b, a FROM link) l ON r.y = l.x),
fam AS (SELECT x AS episode_key, arg_min(y, (batch_no, y)) AS first FROM reach JOIN e ON e.episode_key = y GROUP BY 1)
SELECT least(episode_key, first) AS episode_key_a, greatest(episode_key, first) AS episode_key_b FROM fam WHERE episode_key <> first""",
    "p2_new_batch": REPEATS + """,
cut AS (SELECT *, batch_no > (SELECT max(batch_no) FROM e WHERE batch_no < 2147483647) * 2 // 3 AS new FROM e)
SELECT a AS episode_key_a, b AS episode_key_b FROM link JOIN cut x ON x.episode_key = a JOIN cut y ON y.episode_key = b WHERE x.new OR y.new""",
    "p1_found": """
WITH e AS (SELECT episode_key, any_value(source_id) AS source_id, any_value(video) AS video,
                  coalesce(any_value(video_offset), 0) AS off, any_value(video_end) AS ve FROM episodes GROUP BY 1),
s AS (SELECT DISTINCT st.episode_key, st.frame_index, st.step_time + e.off AS target, e.source_id, e.video, e.off, e.ve
      FROM steps st JOIN e USING (episode_key) WHERE isfinite(st.step_time)),
f AS (SELECT DISTINCT frame_id, source_id, video, pts FROM frames WHERE isfinite(pts))
SELECT episode_key, frame_index, arg_min(frame_id, (abs(target - pts), frame_id)) AS frame_id
FROM s JOIN f USING (source_id, video)
WHERE pts >= off AND (ve IS NULL OR pts < ve) AND abs(target - pts) <= 0.040 GROUP BY 1, 2""",
    "p8_checks": "SELECT DISTINCT doc_id, true AS complete, true AS fits FROM documents WHERE doc_id IS NOT NULL",
    "p9_checks": "SELECT DISTINCT lower(trim(source)) AS source, true AS capped, true AS met FROM mixture_targets WHERE trim(source) <> ''",
    "p6_found": EPISODE_FAMILIES + """
SELECT family_key, episode_key FROM fam
WHERE family_key IN (SELECT family_key FROM fam JOIN e USING (episode_key) GROUP BY 1 HAVING count(DISTINCT s) > 1)""",
    "p6_splits": EPISODE_FAMILIES + """,
h AS (SELECT *, ('0x' || substr(sha256('split-v1|' || family_key), 1, 12))::BIGINT / 281474976710656.0 AS place FROM fam)
SELECT episode_key, family_key, CASE WHEN place < 0.8 THEN 'train' WHEN place < 0.8 + 0.1 THEN 'validation' ELSE 'test' END AS split FROM h""",
}
