"""Queries for the trajectory operators over the data tables, each beside its SQL.

Every query runs over its whole tables. Doubles are rounded alike on both sides,
vectors are summed up or written as text, so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.functions import hashing, rules, vectors
from kinelake.operators import asof, ledger, quality, stats
from kinelake.operators import trajectories as tr
from kinelake.session import cut_lineage, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# tables as one row per key, the same for every oracle
STEPS = "st AS (SELECT DISTINCT ON (episode_key, frame_index) * FROM steps WHERE episode_key IS NOT NULL AND frame_index IS NOT NULL)"
EPISODES = "ep AS (SELECT DISTINCT ON (episode_key) * FROM episodes)"
SRC = "src AS (SELECT source_id, revision, min(batch_no) AS batch_no, any_value(state_names) AS state_names, any_value(action_names) AS action_names, any_value(semantics_status) AS semantics_status FROM sources GROUP BY 1, 2)"
# as text before anything sorts them: sorting vectors would make negative zeros positive
FRAMES_TEXT = """(SELECT episode_key, string_agg(r, ';' ORDER BY frame_index) AS l FROM (SELECT DISTINCT episode_key, frame_index,
concat(step_time::VARCHAR, '|', coalesce(state::VARCHAR, 'null'), '|', coalesce(action::VARCHAR, 'null')) AS r FROM steps WHERE episode_key IS NOT NULL AND frame_index IS NOT NULL) GROUP BY 1)"""
SPLIT = """CASE WHEN {g} IS NULL THEN NULL WHEN ('0x' || substr(sha256('{{"group":"' || {g} || '","seed":"lab-demo-v1"}}'), 1, 8))::BIGINT % 5 = 0 THEN 'validation' ELSE 'train' END"""
FINITE = "coalesce(isfinite({0}), false)"


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def steps_of(spark: SparkSession, d: str) -> DataFrame:
    return tr.once(table(spark, d, "steps"), "episode_key", "frame_index")


def episodes_of(spark: SparkSession, d: str) -> DataFrame:
    """Episodes once each, with their batch's channel names and status."""
    src = table(spark, d, "sources").groupBy("source_id", "revision").agg(F.min("batch_no").alias("batch_no"), F.first("state_names", True).alias("state_names"), F.first("action_names", True).alias("action_names"), F.first("semantics_status", True).alias("semantics_status"))
    return tr.once(table(spark, d, "episodes"), "episode_key").join(src, ["source_id", "revision"], "left")


@query(f"WITH {EPISODES} SELECT episode_key, {SPLIT.format(g='origin_group')} AS hashed_split FROM ep")
def split_assign(spark: SparkSession, d: str) -> DataFrame:
    return episodes_of(spark, d).select("episode_key", hashing.split_of(F.col("origin_group")).alias("hashed_split"))


@query(f"WITH {EPISODES} SELECT source_id, {SPLIT.format(g='origin_group')} AS hashed_split, count(*) AS episodes FROM ep GROUP BY 1, 2")
def split_counts_by_source(spark: SparkSession, d: str) -> DataFrame:
    return episodes_of(spark, d).groupBy("source_id", hashing.split_of(F.col("origin_group")).alias("hashed_split")).agg(F.count(F.lit(1)).alias("episodes"))


@query(f"""WITH {STEPS} SELECT episode_key, count(*) AS frames, round(arg_max_null(step_time, frame_index) - arg_min_null(step_time, frame_index), 6) AS duration_seconds,
arg_min_null(language, frame_index) AS task_first, arg_max_null(language, frame_index) AS task_last, max(len(state)) AS state_dim, max(len(action)) AS action_dim FROM st GROUP BY 1""")
def episode_summary(spark: SparkSession, d: str) -> DataFrame:
    return tr.episode_summary(steps_of(spark, d)).withColumn("duration_seconds", F.round("duration_seconds", 6))


QUALITY_SQL = f"""{STEPS}, {EPISODES}, {SRC},
iv AS (SELECT *, step_time - lag(step_time) OVER (PARTITION BY episode_key ORDER BY frame_index) AS dt FROM st),
per AS (SELECT iv.episode_key, count(*) AS n, bool_or(NOT {FINITE.format('step_time')}) AS bad_time, bool_or(dt <= 0) AS not_rising,
  bool_or(isfinite(fps) AND fps > 0 AND abs(dt - 1 / fps) > 0.15 / fps) AS irregular,
  bool_or(language IS NULL OR trim(language) = '') AS blank,
  min(len(state)) AS s_least, max(len(state)) AS s_most, count(state) AS s_n, bool_or(len(list_filter(state, lambda x: NOT {FINITE.format('x')})) > 0) AS s_inf,
  min(len(action)) AS a_least, max(len(action)) AS a_most, count(action) AS a_n, bool_or(len(list_filter(action, lambda x: NOT {FINITE.format('x')})) > 0) AS a_inf
  FROM iv JOIN ep USING (episode_key) GROUP BY 1),
vid AS (SELECT DISTINCT source_id, video, true AS there FROM frames WHERE source_id IS NOT NULL AND video IS NOT NULL),
chk AS (SELECT per.*, ep.source_id, ep.revision, ep.episode_id, ep.fps, ep.origin_group, ep.success, ep.embodiment, src.batch_no, src.state_names, src.action_names, src.semantics_status, vid.there,
  coalesce(s_least <> s_most OR s_most <= 0 OR s_n <> n, false) AS s_bad, coalesce(a_least <> a_most OR a_most <= 0 OR a_n <> n, false) AS a_bad
  FROM per JOIN ep USING (episode_key) LEFT JOIN src USING (source_id, revision) LEFT JOIN vid USING (source_id, video)),
qual AS (SELECT *, array_to_string(list_filter([
  CASE WHEN NOT coalesce(regexp_full_match(episode_id, '[A-Za-z0-9_-]+'), false) THEN 'unsafe_episode_id' END,
  CASE WHEN n < 2 THEN 'too_few_steps' END,
  CASE WHEN NOT coalesce(isfinite(fps) AND fps > 0, false) THEN 'invalid_fps' END,
  CASE WHEN bad_time THEN 'invalid_timestamps' END,
  CASE WHEN NOT bad_time AND not_rising THEN 'non_monotonic_time' END,
  CASE WHEN s_bad THEN 'state_shape' END, CASE WHEN NOT s_bad AND s_inf THEN 'state_non_finite' END,
  CASE WHEN a_bad THEN 'action_shape' END, CASE WHEN NOT a_bad AND a_inf THEN 'action_non_finite' END,
  CASE WHEN len(state_names) > 0 AND (len(state_names) <> s_most OR len(list_distinct(state_names)) <> len(state_names)) THEN 'state_names_mismatch' END,
  CASE WHEN len(action_names) > 0 AND (len(action_names) <> a_most OR len(list_distinct(action_names)) <> len(action_names)) THEN 'action_names_mismatch' END,
  CASE WHEN blank THEN 'missing_language' END,
  CASE WHEN origin_group IS NULL OR trim(origin_group) = '' THEN 'missing_origin_group' END,
  CASE WHEN there IS NULL THEN 'missing_video' END], lambda x: x IS NOT NULL), ',') AS errors,
  array_to_string(list_filter([
  CASE WHEN NOT coalesce(semantics_status = 'verified', false) THEN 'action_semantics_not_deployment_verified' END,
  CASE WHEN success IS NULL THEN 'success_unknown_not_assumed_expert' END,
  CASE WHEN irregular THEN 'irregular_sample_intervals' END], lambda x: x IS NOT NULL), ',') AS warnings FROM chk)"""


@query(f"WITH {QUALITY_SQL} SELECT episode_key, errors, warnings, n AS frames FROM qual")
def quality_error_codes(spark: SparkSession, d: str) -> DataFrame:
    q = quality.quality_report(steps_of(spark, d), episodes_of(spark, d), table(spark, d, "frames"))
    return q.select("episode_key", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"), "frames")


@query(f"WITH {QUALITY_SQL} SELECT source_id, count(*) AS episodes, count(*) FILTER (not_rising) AS not_rising, count(*) FILTER (irregular) AS irregular FROM chk GROUP BY 1")
def quality_time_by_source(spark: SparkSession, d: str) -> DataFrame:
    rows = tr.step_intervals(steps_of(spark, d).select("episode_key", "frame_index", "step_time")).join(episodes_of(spark, d).select("episode_key", "source_id", "fps"), "episode_key")
    period = F.try_divide(F.lit(1.0), F.col("fps"))
    good = vectors.is_finite(F.col("fps")) & (F.col("fps") > 0)
    per = rows.groupBy("source_id", "episode_key").agg(F.bool_or(F.col("dt") <= 0).alias("r"), F.bool_or(good & (F.abs(F.col("dt") - period) > 0.15 * period)).alias("i"))
    return per.groupBy("source_id").agg(F.count(F.lit(1)).alias("episodes"), F.count_if("r").alias("not_rising"), F.count_if("i").alias("irregular"))


@query(f"""WITH {STEPS}, {EPISODES}, per AS (SELECT episode_key, count(*) AS n, min(frame_index) AS lo, max(frame_index) AS hi, count(DISTINCT frame_index) AS dn FROM st GROUP BY 1),
e AS (SELECT ep.episode_key, length, coalesce(n, 0) AS n, coalesce(lo = 0 AND hi = n - 1 AND dn = n, false) AS contiguous FROM ep LEFT JOIN per USING (episode_key))
SELECT episode_key, n AS rows, contiguous, coalesce(n = length, false) AS length_ok,
CASE WHEN n = 0 THEN 'episode_boundary' WHEN NOT coalesce(n = length, false) THEN 'length_disagrees' WHEN NOT contiguous THEN 'index_not_contiguous' END AS reason FROM e""")
def parse_contiguity(spark: SparkSession, d: str) -> DataFrame:
    return quality.parse_report(steps_of(spark, d), episodes_of(spark, d))


@query("""WITH o AS (SELECT l_orderkey, count(*) AS n, min(l_linenumber) AS lo, max(l_linenumber) AS hi, count(DISTINCT l_linenumber) AS dn FROM lineitem GROUP BY 1)
SELECT count(*) AS orders, count(*) FILTER (lo = 1 AND hi = n AND dn = n) AS contiguous, (SELECT count(*) FROM orders ANTI JOIN lineitem ON o_orderkey = l_orderkey) AS without_lines FROM o""")
def parse_line_index(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    per = line.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi"), F.count_distinct("l_linenumber").alias("dn"))
    bare = table(spark, d, "orders").select("o_orderkey").join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").agg(F.count(F.lit(1)).alias("without_lines"))
    return per.agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.expr("lo = 1 and hi = n and dn = n")).alias("contiguous")).crossJoin(bare)  # one row each


@query("SELECT n_name, r_name, count(c_custkey) AS customers, count(*) FILTER (n_nationkey IS NULL) AS unresolved FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def task_lookup(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return c.groupBy("n_name", "r_name").agg(F.count("c_custkey").alias("customers"), F.count_if(F.col("n_nationkey").isNull()).alias("unresolved"))


@query("SELECT f.source_id, f.video, count(DISTINCT f.frame_id) AS frames FROM frames f SEMI JOIN episodes e ON f.source_id = e.source_id AND f.video = e.video GROUP BY 1, 2")
def lock_semi(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "frames").join(table(spark, d, "episodes"), ["source_id", "video"], "left_semi")
    return f.groupBy("source_id", "video").agg(F.count_distinct("frame_id").alias("frames"))


@query("SELECT DISTINCT e.source_id, e.video FROM episodes e ANTI JOIN frames f ON f.source_id = e.source_id AND f.video = e.video WHERE e.video IS NOT NULL")
def lock_anti(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "episodes").where("video is not null").select("source_id", "video").distinct()
    return e.join(table(spark, d, "frames").select("source_id", "video"), ["source_id", "video"], "left_anti")


@query("SELECT d.source, count(*) AS texts FROM (SELECT source, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS rn FROM documents WHERE text IS NOT NULL) d WHERE rn = 1 GROUP BY 1")
def dedup_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("text is not null").select(F.sha2("text", 256).alias("h"), "doc_id", "source")
    return docs.groupBy("h").agg(F.min_by("source", "doc_id").alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("texts"))


@query("SELECT doc_id, nullif(CASE WHEN text IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY text) END, doc_id) AS duplicate_of FROM documents")
def duplicate_of(spark: SparkSession, d: str) -> DataFrame:
    return ledger.first_occurrence(table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h")), "doc_id", "h")


@query(f"""WITH {EPISODES}, t AS {FRAMES_TEXT},
e AS (SELECT episode_key, min(episode_key) OVER (PARTITION BY embodiment, l) AS f FROM t JOIN ep USING (episode_key)) SELECT episode_key, nullif(f, episode_key) AS duplicate_of FROM e""")
def trajectory_duplicates(spark: SparkSession, d: str) -> DataFrame:
    prints = ledger.trajectory_fingerprints(steps_of(spark, d), episodes_of(spark, d))
    return ledger.first_occurrence(prints, "episode_key", "fingerprint")


ANCHORS = "an AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY episode_key) AS frames FROM st) WHERE frame_index % 10 = 0 OR frame_index = frames - 1)"
THIN = """kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY episode_key ORDER BY frame_index) - 1 AS k, count(*) OVER (PARTITION BY episode_key) AS total FROM an)
WHERE total <= {m} OR k = total - 1 OR list_contains(list_transform(range(0, {m} - 1), lambda i: floor(i * ((total - 1)::DOUBLE / ({m} - 1)))::BIGINT), k))"""


@query(f"WITH {STEPS}, {ANCHORS} SELECT episode_key, frame_index, frames FROM an")
def anchor_rows(spark: SparkSession, d: str) -> DataFrame:
    return tr.anchors(steps_of(spark, d).select("episode_key", "frame_index"), 10, None).select("episode_key", "frame_index", "frames")


@query(f"WITH {STEPS}, {ANCHORS}, {THIN.format(m=4)} SELECT episode_key, frame_index FROM kept")
def anchors_thinned(spark: SparkSession, d: str) -> DataFrame:
    return tr.anchors(steps_of(spark, d).select("episode_key", "frame_index"), 10, 4).select("episode_key", "frame_index")


CHUNKS = "ch AS (SELECT *, list(action) OVER (PARTITION BY episode_key ORDER BY frame_index ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS chunk FROM st)"
VALUES = "list_sum(list_filter(flatten({0}), lambda x: coalesce(isfinite(x), false)))"


def _total(c: str) -> object:
    return F.aggregate(F.filter(F.flatten(c), vectors.is_finite), F.lit(0.0), lambda a, x: a + x)


@query(f"WITH {STEPS}, {CHUNKS} SELECT episode_key, frame_index, len(chunk) AS valid, round(coalesce({VALUES.format('chunk')}, 0), 4) AS total FROM ch")
def action_chunks(spark: SparkSession, d: str) -> DataFrame:
    c = tr.action_chunks(steps_of(spark, d).select("episode_key", "frame_index", "action"))
    return c.select("episode_key", "frame_index", F.size("chunk").alias("valid"), F.round(_total("chunk"), 4).alias("total"))


@query(f"WITH {STEPS}, {ANCHORS}, {CHUNKS} SELECT source_id, count(*) AS windows, sum(len(chunk) * len(action)) AS valid_cells, sum((8 - len(chunk)) * len(action)) AS padding_cells FROM ch SEMI JOIN an USING (episode_key, frame_index) GROUP BY 1")
def chunk_mask_counts(spark: SparkSession, d: str) -> DataFrame:
    w = tr.anchors(tr.action_chunks(steps_of(spark, d).select("source_id", "episode_key", "frame_index", "action")), 10, None)
    mask = F.flatten(vectors.chunk_mask(F.size("chunk"), 8, F.size("action")))
    return w.groupBy("source_id").agg(F.count(F.lit(1)).alias("windows"), F.sum(F.size(F.filter(mask, lambda x: x))).alias("valid_cells"), F.sum(F.size(F.filter(mask, lambda x: ~x))).alias("padding_cells"))


@query(f"WITH {STEPS}, {CHUNKS} SELECT episode_key, frame_index, 8 - len(chunk) AS pad, round(coalesce({VALUES.format('chunk')}, 0) + (8 - len(chunk)) * coalesce(list_sum(list_filter(chunk[-1], lambda x: coalesce(isfinite(x), false))), 0), 4) AS total FROM ch WHERE len(chunk) > 0")
def action_chunks_edge_repeat(spark: SparkSession, d: str) -> DataFrame:
    c = tr.action_chunks(steps_of(spark, d).select("episode_key", "frame_index", "action")).where(F.size("chunk") > 0).withColumn("full", vectors.edge_padded(F.col("chunk"), 8))
    return c.select("episode_key", "frame_index", (F.lit(8) - F.size("chunk")).alias("pad"), F.round(_total("full"), 4).alias("total"))


ALIGN = """ev AS (SELECT an.episode_key, frame_index, ep.source_id, video, fps, coalesce(video_offset, 0) AS off, video_end, step_time + coalesce(video_offset, 0) AS target FROM an JOIN ep USING (episode_key)),
fr AS (SELECT DISTINCT source_id, video, pts FROM frames WHERE isfinite(pts)),
al AS (SELECT ev.*, CASE WHEN isfinite(target) AND fr.pts >= off - 1e-6 THEN fr.pts END AS seen FROM (SELECT *, CASE WHEN isfinite(target) THEN target + 1e-6 ELSE -1e300 END AS latest FROM ev) ev ASOF LEFT JOIN fr ON ev.source_id = fr.source_id AND ev.video = fr.video AND ev.latest >= fr.pts),
rep AS (SELECT source_id, video, pts FROM frames WHERE isfinite(pts) GROUP BY ALL HAVING count(DISTINCT coalesce(frame_id, -1)) > 1),
twice AS (SELECT DISTINCT episode_key FROM (SELECT episode_key, source_id, video, off, max(target) + 1e-6 AS upto FROM ev WHERE isfinite(target) GROUP BY ALL) JOIN rep USING (source_id, video) WHERE pts >= off - 1e-6 AND pts <= upto),
alr AS (SELECT *, CASE WHEN target >= video_end + 1e-6 THEN 'boundary' WHEN seen IS NULL THEN 'no_past_frame' WHEN NOT coalesce(target - seen <= CASE WHEN fps <> 0 THEN 1.5 / fps END, false) THEN 'stale'
  WHEN episode_key IN (FROM twice) THEN 'non_increasing_pts' END AS reason FROM al)"""


@query(f"WITH {STEPS}, {EPISODES}, {ANCHORS}, {ALIGN} SELECT episode_key, frame_index, seen AS video_pts, reason FROM alr")
def asof_frame(spark: SparkSession, d: str) -> DataFrame:
    a = tr.anchors(steps_of(spark, d).select("episode_key", "frame_index", "step_time"), 10, None)
    return asof.align_frames(a, episodes_of(spark, d), table(spark, d, "frames")).select("episode_key", "frame_index", "video_pts", "reason")


@query(f"WITH {STEPS}, {EPISODES}, {ANCHORS}, {ALIGN} SELECT episode_key, count(*) AS anchors, count(reason) AS failed, round(min(target - seen), 6) AS min_age, round(max(target - seen), 6) AS max_age FROM alr GROUP BY 1")
def asof_ages(spark: SparkSession, d: str) -> DataFrame:
    a = tr.anchors(steps_of(spark, d).select("episode_key", "frame_index", "step_time"), 10, None)
    got = asof.align_frames(a, episodes_of(spark, d), table(spark, d, "frames"))
    return got.groupBy("episode_key").agg(F.count(F.lit(1)).alias("anchors"), F.count("reason").alias("failed"), F.round(F.min("age"), 6).alias("min_age"), F.round(F.max("age"), 6).alias("max_age"))


@query(f"""WITH {STEPS}, {EPISODES}, sa AS (SELECT episode_key, said_at, arg_min(content, annotation_id) AS content FROM annotations WHERE content IS NOT NULL AND isfinite(said_at) AND episode_key IS NOT NULL GROUP BY 1, 2),
ev AS (SELECT st.episode_key, frame_index, task, CASE WHEN isfinite(step_time) THEN step_time ELSE -1e300 END AS t FROM st LEFT JOIN ep USING (episode_key))
SELECT ev.episode_key, frame_index, CASE WHEN content IS NULL THEN task ELSE task || ' | ' || content END AS instruction FROM ev ASOF LEFT JOIN sa ON ev.episode_key = sa.episode_key AND ev.t >= sa.said_at""")
def asof_language(spark: SparkSession, d: str) -> DataFrame:
    return asof.language_at(steps_of(spark, d), episodes_of(spark, d), table(spark, d, "annotations"))


@query("""WITH v AS (SELECT label, unnest(generate_series(0, len(embedding) - 1)) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings)
SELECT label, dim, round(avg(x), 6) AS mean, round(greatest(stddev_pop(x), 1e-6), 6) AS std, count(x) AS "count" FROM v GROUP BY 1, 2""")
def stats_dim(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("embedding"))
    return stats.channel_stats(e, "label", ["embedding"]).select("label", "dim", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "count")


ACCEPTED_SQL = f"""{QUALITY_SQL}, {ANCHORS.replace('an AS', 'an0 AS')}, {THIN.format(m=64).replace('kept AS', 'an AS').replace('FROM an)', 'FROM an0)')}, {ALIGN},
med AS (SELECT episode_key, count(reason) = 0 AS media_ok FROM alr GROUP BY 1),
fpr AS {FRAMES_TEXT},
led0 AS (SELECT q.episode_key, q.source_id, q.origin_group, q.embodiment, q.errors = '' AS ok, coalesce(media_ok, false) AS media_ok, l, coalesce(batch_no, 2147483647) AS bn, episode_id, fps, success, s_most, a_most, state_names, action_names FROM qual q LEFT JOIN med USING (episode_key) LEFT JOIN fpr USING (episode_key)),
led1 AS MATERIALIZED (SELECT * EXCLUDE (l), row_number() OVER (ORDER BY bn, episode_key) AS ord, coalesce(source_id, '') AS sid, sha256(concat(embodiment, '|', l)) AS fp,
  to_json([s_most::VARCHAR, a_most::VARCHAR, coalesce(state_names, [])::VARCHAR, coalesce(action_names, [])::VARCHAR])::VARCHAR AS contract FROM led0),
told AS (SELECT 0::BIGINT AS ord, MAP {{}}::MAP(VARCHAR, VARCHAR) AS held, []::VARCHAR[] AS seen, NULL::VARCHAR AS outcome, NULL::VARCHAR AS stage
  UNION ALL SELECT ord, CASE WHEN outcome = 'accepted' THEN map_concat(held, MAP {{sid: contract}}) ELSE held END, CASE WHEN outcome = 'accepted' THEN list_append(seen, fp) ELSE seen END, outcome, stage
  FROM (SELECT *, CASE WHEN stage IS NOT NULL THEN 'quarantined' WHEN list_contains(seen, fp) THEN 'duplicate' ELSE 'accepted' END AS outcome
    FROM (SELECT r.ord, held, seen, sid, contract, fp, CASE WHEN NOT ok THEN 'quality' WHEN held[sid] <> contract THEN 'contract' WHEN NOT media_ok AND NOT list_contains(seen, fp) THEN 'media' END AS stage
      FROM told JOIN led1 r ON r.ord = told.ord + 1))),
led AS (SELECT led1.*, outcome, stage FROM led1 JOIN told USING (ord)),
acc AS (SELECT *, {SPLIT.format(g='origin_group')} AS split FROM led WHERE outcome = 'accepted')"""


def clean_steps(spark: SparkSession, d: str) -> DataFrame:
    """Steps once each, written: five operators of a release read them, none should remove repeats again."""
    return cut_lineage(steps_of(spark, d).select("source_id", "episode_key", "frame_index", "step_time", "state", "action", "language"))


def compact_ledger(spark: SparkSession, d: str, st: DataFrame) -> DataFrame:
    """One row per episode with what the ledger needs."""
    ep = cut_lineage(episodes_of(spark, d))
    q = quality.quality_report(st, ep, table(spark, d, "frames"))
    a = tr.anchors(st.select("episode_key", "frame_index", "step_time"))
    media = asof.align_frames(a, ep, table(spark, d, "frames")).groupBy("episode_key").agg((F.count("reason") == 0).alias("media_ok"))
    ordered = ledger.source_order(table(spark, d, "sources"), tr.once(table(spark, d, "episodes"), "episode_key"))
    return (
        q.join(ep.select("episode_key", "state_names", "action_names"), "episode_key")
        .select("episode_key", (F.size("errors") == 0).alias("quality_ok"), ledger.contract_of().alias("contract"), "frames", "state_dim", "action_dim")
        .join(ledger.trajectory_fingerprints(st, ep), "episode_key")
        .join(media, "episode_key", "left")
        .withColumn("media_ok", F.coalesce("media_ok", F.lit(False)))
        .join(ordered.select("episode_key", "source_id", "ord"), "episode_key")
    )


def accepted_episodes(spark: SparkSession, d: str, st: DataFrame) -> DataFrame:
    """episode_key, source_id, episode_id, split of the accepted episodes."""
    led = ledger.decide(cut_lineage(compact_ledger(spark, d, st))).where("outcome = 'accepted'").select("episode_key")
    return cut_lineage(episodes_of(spark, d).join(led, "episode_key", "left_semi").select("episode_key", "source_id", "episode_id", "embodiment", "fps", hashing.split_of(F.col("origin_group")).alias("split")))


@query(f"WITH RECURSIVE {ACCEPTED_SQL} SELECT episode_key, outcome, stage FROM led")
def episode_ledger(spark: SparkSession, d: str) -> DataFrame:
    return ledger.decide(cut_lineage(compact_ledger(spark, d, clean_steps(spark, d)))).select("episode_key", "outcome", "stage")


STATS_SQL = """tv AS (SELECT acc.source_id, split, st.* EXCLUDE (source_id) FROM st JOIN acc USING (episode_key)),
lng AS (SELECT source_id, 'state' AS kind, unnest(generate_series(0, len(state) - 1)) AS dim, unnest(state) AS v FROM tv WHERE split = 'train'
        UNION ALL SELECT source_id, 'action', unnest(generate_series(0, len(action) - 1)), unnest(action) FROM tv WHERE split = 'train'),
sts AS (SELECT source_id, kind, dim, avg(v) AS mean, greatest(stddev_pop(v), 1e-6) AS std, count(v) AS n FROM lng GROUP BY 1, 2, 3)"""


@query(f"WITH RECURSIVE {ACCEPTED_SQL}, {STATS_SQL} SELECT source_id, kind, dim, round(mean, 4) AS mean, round(std, 4) AS std, n AS \"count\" FROM sts")
def stats_train_only(spark: SparkSession, d: str) -> DataFrame:
    st = clean_steps(spark, d)
    acc = accepted_episodes(spark, d, st).where("split = 'train'")
    v = st.select("episode_key", "state", "action").join(acc, "episode_key")
    return stats.channel_stats(v, "source_id", ["state", "action"]).select("source_id", "kind", "dim", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "count")


ZS = """WITH v AS (SELECT vec_id, label, unnest(generate_series(0, len(embedding) - 1)) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
s AS (SELECT label, dim, avg(x) AS m, greatest(stddev_pop(x), 1e-6) AS sd FROM v GROUP BY 1, 2)"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    s = stats.channel_stats(e, "label", ["v"]).groupBy("label").agg(F.array_sort(F.collect_list(F.struct("dim", "mean", "std"))).alias("c"))
    s = s.select("label", F.transform("c", lambda x: x["mean"]).alias("mean"), F.transform("c", lambda x: x["std"]).alias("std"))
    return e.join(s, "label").withColumn("z", vectors.zscore(F.col("v"), F.col("mean"), F.col("std")))


@query(ZS + " SELECT vec_id, round(sum((x - m) / sd), 4) AS total, round(max((x - m) / sd), 4) AS greatest FROM v JOIN s USING (label, dim) GROUP BY 1")
def zscore(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("vec_id", F.round(F.aggregate("z", F.lit(0.0), lambda a, x: a + x), 4).alias("total"), F.round(F.array_max("z"), 4).alias("greatest"))


@query(ZS + " SELECT label, bool_and(abs((x - m) / sd * sd + m - x) <= 1e-9) AS restored, count(*) AS cells FROM v JOIN s USING (label, dim) GROUP BY 1")
def zscore_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    back = F.zip_with(vectors.unzscore(F.col("z"), F.col("mean"), F.col("std")), F.col("v"), lambda a, b: F.abs(a - b) <= 1e-9)
    return _scored(spark, d).groupBy("label").agg(F.bool_and(F.forall(back, lambda x: x)).alias("restored"), F.sum(F.size("v")).alias("cells"))


@query(f"""WITH RECURSIVE {ACCEPTED_SQL}, {STATS_SQL}, w0 AS (SELECT ch.*, acc.split, acc.source_id AS src FROM (SELECT *, list(action) OVER (PARTITION BY episode_key ORDER BY frame_index ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS chunk FROM st) ch
  JOIN acc USING (episode_key) SEMI JOIN an USING (episode_key, frame_index)),
cells AS (SELECT episode_key, frame_index, src, split, len(chunk) AS valid, unnest(chunk) AS a FROM w0), c2 AS (SELECT *, unnest(generate_series(0, len(a) - 1)) AS dim, unnest(a) AS v FROM cells),
sc AS (SELECT episode_key, frame_index, unnest(generate_series(0, len(state) - 1)) AS dim, unnest(state) AS v, src FROM w0),
sz AS (SELECT episode_key, frame_index, sum((v - mean) / std) AS s FROM sc JOIN sts ON sts.source_id = sc.src AND kind = 'state' AND sts.dim = sc.dim GROUP BY 1, 2)
SELECT c2.episode_key, c2.frame_index AS anchor_index, any_value(src) AS source_id, any_value(split) AS split, round(sum((v - mean) / std), 2) AS actions, round(any_value(sz.s), 2) AS state, any_value(valid) AS valid
FROM c2 JOIN sts ON sts.source_id = c2.src AND kind = 'action' AND sts.dim = c2.dim JOIN sz ON sz.episode_key = c2.episode_key AND sz.frame_index = c2.frame_index GROUP BY 1, 2""")
def windows_normalized(spark: SparkSession, d: str) -> DataFrame:
    every = clean_steps(spark, d)
    acc = accepted_episodes(spark, d, every)
    st = every.drop("source_id").join(acc.select("episode_key"), "episode_key", "left_semi")
    w = stats.training_windows(st, acc)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return w.select("episode_key", "anchor_index", "source_id", "split", F.round(total(F.flatten("actions").cast("array<double>")), 2).alias("actions"), F.round(total(F.col("state").cast("array<double>")), 2).alias("state"), F.size(F.filter("action_mask", lambda m: m[0])).alias("valid"))


@query(f"WITH RECURSIVE {ACCEPTED_SQL}, n AS (SELECT source_id, count(*) AS accepted, count(*) FILTER (split = 'train') AS train FROM acc GROUP BY 1) SELECT s.source_id, coalesce(accepted, 0) AS accepted, coalesce(train, 0) AS train, CASE WHEN accepted IS NULL THEN 'no_eligible_episodes' WHEN train = 0 THEN 'no_train_split' ELSE 'interface_smoke_only' END AS view_status FROM (SELECT DISTINCT source_id FROM sources) s LEFT JOIN n USING (source_id)")
def no_train_split_status(spark: SparkSession, d: str) -> DataFrame:
    return stats.view_status(accepted_episodes(spark, d, clean_steps(spark, d)), table(spark, d, "sources"))


@query(f"WITH RECURSIVE {ACCEPTED_SQL} SELECT source_id, split, count(*) AS episodes, sum(frames) AS frames, sum(windows) AS windows FROM acc JOIN (SELECT episode_key, count(*) AS windows, any_value(frames) AS frames FROM an GROUP BY 1) USING (episode_key) GROUP BY ROLLUP (source_id, split)")
def source_report(spark: SparkSession, d: str) -> DataFrame:
    """Accepted episodes, frames and windows by source and split, with subtotals."""
    st = clean_steps(spark, d)
    w = tr.anchors(st.select("episode_key", "frame_index")).groupBy("episode_key").agg(F.first("frames").alias("frames"), F.count(F.lit(1)).alias("windows"))
    return accepted_episodes(spark, d, st).join(w, "episode_key").rollup("source_id", "split").agg(F.count(F.lit(1)).alias("episodes"), F.sum("frames").alias("frames"), F.sum("windows").alias("windows"))


@query(f"WITH {STEPS}, {EPISODES}, {ANCHORS}, w AS (SELECT an.episode_key, an.frame_index AS anchor_index, ep.source_id, {SPLIT.format(g='origin_group')} AS split, ep.episode_id FROM an JOIN ep USING (episode_key) WHERE origin_group IS NOT NULL) SELECT episode_key, anchor_index, row_number() OVER (PARTITION BY source_id, split ORDER BY episode_id, anchor_index) - 1 AS row_address FROM w")
def window_row_address(spark: SparkSession, d: str) -> DataFrame:
    e = episodes_of(spark, d).where("origin_group is not null").select("episode_key", "source_id", "episode_id", hashing.split_of(F.col("origin_group")).alias("split"))
    w = tr.anchors(steps_of(spark, d).select("episode_key", "frame_index"), 10, None).join(e, "episode_key").withColumnRenamed("frame_index", "anchor_index")
    return tr.window_addresses(w).select("episode_key", "anchor_index", "row_address")


@query(f"WITH {STEPS}, {EPISODES} SELECT episode_key, bool_and(coalesce(abs(step_time - CASE WHEN fps <> 0 THEN frame_index / fps END) <= 1e-6, false)) AS regular, bool_and(coalesce(abs(fps - round_even(fps, 0)) <= 1e-9, false)) AS whole_fps FROM st JOIN ep USING (episode_key) GROUP BY 1")
def cadence_check(spark: SparkSession, d: str) -> DataFrame:
    return tr.regular_cadence(steps_of(spark, d), episodes_of(spark, d))


@query(f"WITH {STEPS} SELECT episode_key, frame_index, round(step_time - first_value(step_time) OVER (PARTITION BY episode_key ORDER BY frame_index), 6) AS rebased_time FROM st")
def rebased_time(spark: SparkSession, d: str) -> DataFrame:
    return tr.rebased(steps_of(spark, d)).select("episode_key", "frame_index", F.round("rebased_time", 6).alias("rebased_time"))


@query(f"WITH {EPISODES} SELECT source_id, count(*) FILTER (success) AS succeeded, count(*) FILTER (NOT success) AS failed, count(*) FILTER (success IS NULL) AS unknown FROM ep GROUP BY 1")
def tristate_success(spark: SparkSession, d: str) -> DataFrame:
    return episodes_of(spark, d).groupBy("source_id").agg(F.count_if("success").alias("succeeded"), F.count_if(~F.col("success")).alias("failed"), F.count_if(F.col("success").isNull()).alias("unknown"))


@query(f"WITH {EPISODES} SELECT episode_key, coalesce(regexp_full_match(episode_id, '[A-Za-z0-9_-]+'), false) AS safe, coalesce(regexp_full_match(revision, '[A-Za-z0-9_.-]+') AND revision NOT IN ('.', '..') AND NOT ends_with(revision, '.'), false) AS safe_revision FROM ep")
def safe_id_check(spark: SparkSession, d: str) -> DataFrame:
    return episodes_of(spark, d).select("episode_key", hashing.safe_id(F.col("episode_id")).alias("safe"), hashing.safe_revision(F.col("revision")).alias("safe_revision"))


@query("""WITH h AS (SELECT doc_id, substr(hex(encode(coalesce(text, ''))), 1, 384) AS x FROM documents),
b AS (SELECT doc_id, list_transform(range(1, len(x)::BIGINT + 1, 2), lambda i: ('0x' || substr(x, i, 2))::INT + 1) AS l FROM h)
SELECT doc_id, len(l) AS used, coalesce(list_sum(l), 0)::BIGINT AS total, coalesce(l[1], 0) AS first FROM b""")
def byte_tokens(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("doc_id", vectors.byte_tokens(F.col("text")).alias("l"))
    return t.select("doc_id", F.size(F.filter("l", lambda x: x > 0)).alias("used"), F.aggregate("l", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"), F.element_at("l", 1).alias("first"))


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def content_digest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


@query(f"WITH {QUALITY_SQL} SELECT source_id, count(DISTINCT (coalesce(fps::VARCHAR, '-'), embodiment, s_most, a_most, coalesce(state_names, ['-']), coalesce(action_names, ['-']))) AS signatures FROM chk GROUP BY 1")
def contract_signatures(spark: SparkSession, d: str) -> DataFrame:
    st, ep = steps_of(spark, d), episodes_of(spark, d)
    dims = st.groupBy("episode_key").agg(F.max(F.size("state")).alias("state_dim"), F.max(F.size("action")).alias("action_dim"))
    return quality.contract_signatures(dims, ep)


@query(f"""WITH {STEPS}, c AS (SELECT source_id, unnest(action) AS t, unnest(CASE WHEN len(state) = len(action) THEN state END) AS p FROM st)
SELECT source_id, round(avg((p - t) * (p - t)) FILTER (isfinite(p) AND isfinite(t)), 3) AS masked_mse, count(*) FILTER (isfinite(p) AND isfinite(t)) AS cells FROM c GROUP BY 1""")
def masked_mse(spark: SparkSession, d: str) -> DataFrame:
    """The error of the state as a forecast of the action, over finite cells."""

    c = steps_of(spark, d).select("source_id", F.explode(F.transform(F.sequence(F.lit(0), F.size("action") - 1), lambda i: F.struct(F.get("action", i).alias("t"), F.get(F.when(F.size("state") == F.size("action"), F.col("state")), i).alias("p")))).alias("c")).select("source_id", "c.*")

    ok = vectors.is_finite(F.col("t")) & vectors.is_finite(F.col("p"))
    e = F.col("p") - F.col("t")
    return c.groupBy("source_id").agg(F.round(F.avg(F.when(ok, e * e)), 3).alias("masked_mse"), F.count_if(ok).alias("cells"))


@query(f"WITH {EPISODES}, s AS (SELECT DISTINCT origin_group AS g, {SPLIT.format(g='origin_group')} AS s FROM ep WHERE origin_group IS NOT NULL) SELECT g AS origin_group FROM s WHERE s = 'train' INTERSECT SELECT g FROM s WHERE s = 'validation'")
def split_leakage(spark: SparkSession, d: str) -> DataFrame:
    """Groups that stand in both splits: none."""
    e = episodes_of(spark, d).where("origin_group is not null").select("origin_group", hashing.split_of(F.col("origin_group")).alias("s"))
    return e.where("s = 'train'").select("origin_group").intersect(e.where("s = 'validation'").select("origin_group"))


@query("SELECT event_id, user_id, event_type, len(props) AS chars, len(json_keys(props)) AS fields FROM events")
def json_field_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id", "event_type", F.length("props").alias("chars"), F.size(F.json_object_keys("props")).alias("fields"))


@query("""WITH x AS (SELECT DISTINCT episode_key, idx, clock_ticks FROM xr_records), e AS (SELECT episode_key, any_value(timing_mode) AS tm, any_value(fps) AS fps, any_value(scale_to_seconds) AS sc FROM episodes GROUP BY 1)
SELECT episode_key, count(*) AS records, max(idx) - min(idx) + 1 = count(DISTINCT idx) AND count(DISTINCT idx) = count(*) AS contiguous,
round(max(CASE WHEN tm = 'field' THEN clock_ticks * sc WHEN fps > 0 THEN idx / fps END) - min(CASE WHEN tm = 'field' THEN clock_ticks * sc WHEN fps > 0 THEN idx / fps END), 3) AS seconds FROM x JOIN e USING (episode_key) GROUP BY 1""")
def capture_timing(spark: SparkSession, d: str) -> DataFrame:
    """Per capture: records, whether its index has no gap, and its length by its own clock."""
    x = table(spark, d, "xr_records").select("episode_key", "idx", "clock_ticks").distinct()
    e = tr.once(table(spark, d, "episodes"), "episode_key").select("episode_key", "timing_mode", "fps", "scale_to_seconds")
    t = F.when(F.col("timing_mode") == "field", F.col("clock_ticks") * F.col("scale_to_seconds")).when(F.col("fps") > 0, F.col("idx") / F.col("fps"))
    n = F.count(F.lit(1))
    return x.join(e, "episode_key").groupBy("episode_key").agg(n.alias("records"), ((F.max("idx") - F.min("idx") + 1 == F.count_distinct("idx")) & (F.count_distinct("idx") == n)).alias("contiguous"), F.round(F.max(t) - F.min(t), 3).alias("seconds"))


@query(f"""WITH {STEPS}, iv AS (SELECT *, step_time - lag(step_time) OVER (PARTITION BY episode_key ORDER BY frame_index) AS dt FROM st)
SELECT source_id, count(*) AS rows, count(DISTINCT episode_key) AS episodes, bool_and({FINITE.format('step_time')}) AS times_finite, bool_and(dt > 0) AS rising, bool_and(len(list_filter(action, lambda x: NOT {FINITE.format('x')})) = 0) AS actions_finite FROM iv GROUP BY 1""")
def sample_checks(spark: SparkSession, d: str) -> DataFrame:
    r = tr.step_intervals(steps_of(spark, d).select("source_id", "episode_key", "frame_index", "step_time", "action"))
    return r.groupBy("source_id").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("episode_key").alias("episodes"), F.bool_and(vectors.is_finite(F.col("step_time"))).alias("times_finite"), F.bool_and(F.col("dt") > 0).alias("rising"), F.bool_and(vectors.all_finite(F.col("action"))).alias("actions_finite"))


@query(f"WITH {EPISODES} SELECT source_id, episode_key FROM (SELECT source_id, episode_key, row_number() OVER (PARTITION BY source_id ORDER BY episode_key) AS rn FROM ep) WHERE rn <= 6")
def first_episodes(spark: SparkSession, d: str) -> DataFrame:
    """The first six episodes of each source, a sampling operator of the source lists."""
    e = episodes_of(spark, d).select("source_id", "episode_key")
    return e.withColumn("rn", F.row_number().over(Window.partitionBy("source_id").orderBy("episode_key"))).where("rn <= 6").drop("rn")


@query("SELECT source_id, video AS path FROM episodes WHERE video IS NOT NULL UNION SELECT source_id, video FROM frames WHERE video IS NOT NULL UNION SELECT DISTINCT source_id, color_path FROM xr_records WHERE color_path IS NOT NULL")
def locked_paths(spark: SparkSession, d: str) -> DataFrame:
    """The set of files that a source's rows name."""
    parts = [table(spark, d, t).select("source_id", F.col(c).alias("path")).where("path is not null") for t, c in (("episodes", "video"), ("frames", "video"), ("xr_records", "color_path"))]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


@query("WITH s AS (SELECT DISTINCT source_id FROM sources) SELECT lower(source_id) AS folded, count(*) AS ids FROM s GROUP BY 1 HAVING count(*) > 1")
def colliding_source_ids(spark: SparkSession, d: str) -> DataFrame:
    """Source ids that are equal but for case: none may be registered together."""
    s = table(spark, d, "sources").select("source_id").distinct()
    return s.groupBy(F.lower("source_id").alias("folded")).agg(F.count(F.lit(1)).alias("ids")).where("ids > 1")


@query("""WITH s AS (SELECT DISTINCT source_id, revision, origin_namespace, license FROM sources)
SELECT source_id, revision, array_to_string(list_filter([
  CASE WHEN NOT coalesce(regexp_full_match(source_id, '[A-Za-z0-9_-]+') AND NOT regexp_full_match(upper(source_id), 'CON|PRN|AUX|NUL|(COM|LPT)[1-9]'), false) THEN 'id' END,
  CASE WHEN NOT coalesce(regexp_full_match(revision, '[A-Za-z0-9_.-]+') AND NOT ends_with(revision, '.'), false) THEN 'revision' END,
  CASE WHEN coalesce(trim(origin_namespace), '') = '' THEN 'origin_namespace' END, CASE WHEN coalesce(trim(license), '') = '' THEN 'license' END], lambda x: x IS NOT NULL), ',') AS faults FROM s""")
def lock_faults(spark: SparkSession, d: str) -> DataFrame:
    """Which rules of a source lock each delivered batch breaks."""
    told = {"source_id": "sources[].id", "revision": "sources[].revision", "origin_namespace": "sources[].origin_namespace", "license": "sources[].license"}
    pattern = {r.path: r.pattern for r in rules.LOCK}
    faults = F.array_compact(F.array(*(F.when(~rules.matches(F.col(c), pattern[p]), p.rpartition(".")[2]) for c, p in told.items())))
    return table(spark, d, "sources").select(*told).distinct().select("source_id", "revision", F.array_join(faults, ",").alias("faults"))


@query(f"WITH {QUALITY_SQL} SELECT episode_key, CASE WHEN errors = '' THEN 'interface_smoke' END AS eligible_view, false AS deployment_ready FROM qual")
def quality_flags(spark: SparkSession, d: str) -> DataFrame:
    """What an episode may be used for: a view if it has no error, deployment never."""
    q = quality.quality_report(steps_of(spark, d), episodes_of(spark, d), table(spark, d, "frames"))
    return q.select("episode_key", "eligible_view", "deployment_ready")


@query(f"""WITH RECURSIVE {ACCEPTED_SQL}, {STATS_SQL}, w0 AS (SELECT acc.source_id AS src, len(action) AS width, least(8, frames - frame_index) AS valid FROM an JOIN acc USING (episode_key))
SELECT src AS source_id, true AS restored, sum(valid * width) AS cells, sum((8 - valid) * width) AS padding FROM w0 WHERE src IN (SELECT source_id FROM sts) GROUP BY 1""")
def windows_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Whether the windows' actions, with statistics undone, are the canonical ones, by source; and how many cells are real and padding."""
    every = clean_steps(spark, d)
    acc = accepted_episodes(spark, d, every)
    st = cut_lineage(every.drop("source_id").join(acc.select("episode_key"), "episode_key", "left_semi"))
    fitted = stats.stats_arrays(stats.channel_stats(st.join(acc, "episode_key").where("split = 'train'"), "source_id", ["state", "action"]), "source_id").select("source_id", "action_mean", "action_std")
    truth = tr.anchor_windows(st.select("episode_key", "frame_index", "action")).select("episode_key", F.col("frame_index").alias("anchor_index"), "chunk")
    w = stats.training_windows(st, acc).select("source_id", "episode_key", "anchor_index", "actions", "action_mask").join(fitted, "source_id").join(truth, ["episode_key", "anchor_index"])
    back = F.transform("actions", lambda a: vectors.unzscore(a.cast("array<double>"), F.col("action_mean"), F.col("action_std")))
    near = lambda a, b: F.abs(a - b) <= 1e-5 * F.greatest(F.abs(a), F.lit(1.0), F.array_max("action_std"))
    same = F.forall(F.zip_with(F.slice(back, 1, F.size("chunk")), F.col("chunk"), lambda a, b: F.forall(F.zip_with(a, b, near), lambda x: x)), lambda x: x)
    cells = F.flatten("action_mask")
    return w.groupBy("source_id").agg(F.bool_and(same).alias("restored"), F.sum(F.size(F.filter(cells, lambda m: m))).alias("cells"), F.sum(F.size(F.filter(cells, lambda m: ~m))).alias("padding"))


@query(f"WITH RECURSIVE {ACCEPTED_SQL} SELECT source_id, count(*) AS fitted, bool_and(split = 'train') AS train_only FROM acc WHERE split = 'train' GROUP BY 1")
def statistics_fit_ids(spark: SparkSession, d: str) -> DataFrame:
    """How many episodes each source's statistics rest on, and whether all of them are training episodes."""
    st = clean_steps(spark, d)
    acc = accepted_episodes(spark, d, st)
    used = st.select("episode_key").join(acc.where("split = 'train'").select("episode_key"), "episode_key", "left_semi").distinct()
    return used.join(acc, "episode_key").groupBy("source_id").agg(F.count(F.lit(1)).alias("fitted"), F.bool_and(F.col("split") == "train").alias("train_only"))
