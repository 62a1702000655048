"""Queries over the problem tables for the core's operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.operators import known_at, regular_grid, schema_drift, spikes
from kinelake.session import table


def _grid(spark: SparkSession, d: str) -> DataFrame:
    readings = regular_grid.episode_readings(table(spark, d, "steps"), table(spark, d, "xr_records"), table(spark, d, "episodes"))
    return regular_grid.regularize(readings, table(spark, d, "episodes"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return regular_grid.missing_slots(_grid(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return schema_drift.schema_changes(table(spark, d, "metadata_inspections")).select("inspection_id", "field", "change")


def p4_features(spark: SparkSession, d: str) -> DataFrame:
    """The features of every readable file."""
    return schema_drift.features_long(schema_drift.feature_table(table(spark, d, "metadata_inspections"))).select("inspection_id", "name", "dtype", "shape")


def p4_unified(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose columns drift over three deliveries, read into one table: renames are found by value sketches and names, types united."""
    every = table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    part = F.pmod("doc_id", F.lit(3))
    first = every.where(part == 0)
    second = every.where(part == 1).select("doc_id", F.col("text").alias("body_text"), F.col("lang").alias("lang_code"), F.col("source").alias("origin"))
    third = every.where(part == 2).select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("body"), F.col("lang").alias("lang_code"), F.col("source").alias("origin"))
    return schema_drift.unify([first, second, third], least=0.4)[0].select("doc_id", F.length("body").alias("chars"), "lang_code", "origin", F.col("n_chars").isNotNull().alias("counted"))


def p3_grid(spark: SparkSession, d: str) -> DataFrame:
    """Every slot of every series: how many channels got a value, and whether a reading fills it."""
    return _grid(spark, d).select("episode_key", "slot", "missing", F.size(F.filter("value", lambda v: v.isNotNull())).alias("channels"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return known_at.annotation_at_steps(table(spark, d, "steps"), table(spark, d, "annotations")).select("episode_key", "frame_index", "annotation_id")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return spikes.implausible_components(table(spark, d, "steps"), table(spark, d, "sources"))


def p7_limits(spark: SparkSession, d: str) -> DataFrame:
    """The flags that have a definition: values beyond the limit or not finite, and stuck runs."""
    found = spikes.implausible(table(spark, d, "steps"), table(spark, d, "sources"))
    return found.where("kind in ('limit', 'stuck')").select("episode_key", "frame_index", "field", "dim", "kind")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p3_found, p3_grid, p4_found, p4_features, p4_unified, p5_found, p7_found, p7_limits)}

FEATURES_SQL = r"""
WITH once AS (SELECT DISTINCT ON (inspection_id) inspection_id, dataset_id, inspected_at, payload FROM metadata_inspections WHERE json_valid(payload)),
files AS (
  SELECT inspection_id, dataset_id, inspected_at, coalesce(payload->'$.features', payload->'$.metadata.features') AS raw,
         regexp_replace(trim(coalesce(payload->>'$.metadata.codebase_version', payload->>'$.codebase_version')), '^[vV]([0-9])', '\1') AS version
  FROM once WHERE json_type(payload) = 'OBJECT' AND json_type(coalesce(payload->'$.features', payload->'$.metadata.features')) IN ('OBJECT', 'ARRAY')),
item AS (
  SELECT inspection_id, unnest(json_keys(raw)) AS name, raw->name AS spec FROM files WHERE json_type(raw) = 'OBJECT'
  UNION ALL SELECT inspection_id, coalesce(x->>'$.key', x->>'$.name'), x FROM (SELECT inspection_id, unnest(raw->'$[*]') AS x FROM files WHERE json_type(raw) = 'ARRAY')),
typed AS (SELECT inspection_id, name, lower(trim(CASE WHEN json_type(spec) = 'OBJECT' THEN spec->>'$.dtype' ELSE spec->>'$' END)) AS t, coalesce(spec->>'$.shape', '') AS sh FROM item WHERE name IS NOT NULL),
ft AS (SELECT inspection_id, {'name': name, 'dtype': CASE t WHEN 'double' THEN 'float64' WHEN 'float' THEN 'float32' WHEN 'long' THEN 'int64' WHEN 'str' THEN 'string' WHEN 'boolean' THEN 'bool' ELSE t END,
  'shape': array_to_string(list_transform(regexp_extract_all(regexp_replace(sh, '\.0+\b', '', 'g'), '[0-9]+'), lambda x: x::BIGINT::VARCHAR), ',')} AS f FROM typed)
"""

ORACLES: dict[str, str] = {
    "p3_grid": """
WITH e AS (SELECT episode_key, any_value(fps) AS fps, any_value(timing_mode) AS tm, any_value(scale_to_seconds) AS sc FROM episodes GROUP BY 1),
r AS (SELECT episode_key, step_time AS t, state AS v FROM steps
      UNION ALL SELECT episode_key, CASE WHEN tm = 'nominal_index' THEN idx / fps WHEN tm = 'field' THEN clock_ticks * sc END, qpos FROM xr_records JOIN e USING (episode_key) WHERE qpos IS NOT NULL),
f AS (SELECT r.episode_key, t, fps, v FROM r JOIN e USING (episode_key) WHERE isfinite(t) AND isfinite(fps) AND fps > 0),
z AS (SELECT episode_key, min(t) AS t0 FROM f GROUP BY 1),
k AS (SELECT episode_key, count(DISTINCT i) AS channels FROM (SELECT episode_key, unnest(v) AS x, unnest(range(0, len(v))) AS i FROM f) WHERE isfinite(x) GROUP BY 1),
s AS (SELECT DISTINCT episode_key, floor((t - t0) * fps + 0.5)::BIGINT AS slot FROM f JOIN z USING (episode_key)),
g AS (SELECT episode_key, unnest(generate_series(0, max(slot))) AS slot FROM s GROUP BY 1)
SELECT g.episode_key, g.slot, (g.episode_key, g.slot) NOT IN (SELECT (episode_key, slot) FROM s) AS missing, coalesce(channels, 0) AS channels FROM g LEFT JOIN k USING (episode_key)""",
    "p3_found": """
WITH e AS (SELECT episode_key, any_value(fps) AS fps, any_value(timing_mode) AS tm, any_value(scale_to_seconds) AS sc FROM episodes GROUP BY 1),
r AS (SELECT episode_key, step_time AS t FROM steps
      UNION ALL
      SELECT episode_key, CASE WHEN tm = 'nominal_index' THEN idx / fps WHEN tm = 'field' THEN clock_ticks * sc END
      FROM xr_records JOIN e USING (episode_key) WHERE qpos IS NOT NULL),
f AS (SELECT r.episode_key, t, fps FROM r JOIN e USING (episode_key) WHERE isfinite(t) AND isfinite(fps) AND fps > 0),
z AS (SELECT episode_key, min(t) AS t0 FROM f GROUP BY 1),
s AS (SELECT DISTINCT episode_key, floor((t - t0) * fps + 0.5)::BIGINT AS slot FROM f JOIN z USING (episode_key)),
g AS (SELECT episode_key, unnest(generate_series(0, max(slot))) AS slot FROM s GROUP BY 1)
SELECT g.episode_key, g.slot FROM g ANTI JOIN s USING (episode_key, slot)""",
    "p4_features": FEATURES_SQL + " SELECT inspection_id, f.name AS name, f.dtype AS dtype, f.shape AS shape FROM ft",
    "p4_found": FEATURES_SQL + """,
lead AS (SELECT inspection_id, lag(inspection_id) OVER o AS before, version, lag(version) OVER o AS version_before FROM files WHERE dataset_id IS NOT NULL WINDOW o AS (PARTITION BY dataset_id ORDER BY inspected_at NULLS FIRST, inspection_id)),
pair AS (SELECT * FROM lead WHERE before IS NOT NULL),
n AS (SELECT pair.inspection_id, f.* FROM pair JOIN ft USING (inspection_id)), o AS (SELECT pair.inspection_id, f.* FROM pair JOIN ft ON ft.inspection_id = before),
come AS (SELECT *, count(*) OVER (PARTITION BY inspection_id, coalesce(dtype, ''), shape) AS k FROM (FROM n ANTI JOIN o USING (inspection_id, name))),
gone AS (SELECT *, count(*) OVER (PARTITION BY inspection_id, coalesce(dtype, ''), shape) AS k FROM (FROM o ANTI JOIN n USING (inspection_id, name))),
moved AS (SELECT c.inspection_id, c.name AS new, g.name AS old FROM come c JOIN gone g ON c.inspection_id = g.inspection_id AND c.dtype IS NOT DISTINCT FROM g.dtype AND c.shape = g.shape AND c.k = 1 AND g.k = 1)
SELECT inspection_id, new AS field, 'renamed' AS change FROM moved
UNION ALL SELECT inspection_id, name, 'added' FROM come WHERE (inspection_id, name) NOT IN (SELECT inspection_id, new FROM moved)
UNION ALL SELECT inspection_id, name, 'removed' FROM gone WHERE (inspection_id, name) NOT IN (SELECT inspection_id, old FROM moved)
UNION ALL SELECT inspection_id, name, 'dtype_changed' FROM n JOIN o USING (inspection_id, name) WHERE n.dtype IS DISTINCT FROM o.dtype
UNION ALL SELECT inspection_id, name, 'shape_changed' FROM n JOIN o USING (inspection_id, name) WHERE n.shape <> o.shape
UNION ALL SELECT inspection_id, 'codebase_version', 'version_changed' FROM pair WHERE version IS DISTINCT FROM version_before""",
    "p4_unified": "SELECT doc_id::VARCHAR AS doc_id, length(text) AS chars, lang AS lang_code, source AS origin, n_chars IS NOT NULL AND doc_id % 3 = 0 AS counted FROM documents",
    "p7_limits": """
WITH s AS (SELECT DISTINCT ON (episode_key, frame_index) * FROM steps WHERE episode_key IS NOT NULL AND frame_index IS NOT NULL),
c AS (SELECT source_id, episode_key, frame_index, 'state' AS field, unnest(range(0, len(state) - 1))::INT AS dim, unnest(state[:-2]) AS v FROM s
      UNION ALL SELECT source_id, episode_key, frame_index, 'action', unnest(range(0, len(action) - 1))::INT, unnest(action[:-2]) FROM s),
l AS (SELECT source_id, max(joint_limit) AS lim FROM sources GROUP BY 1),
r AS (SELECT *, NOT coalesce(isfinite(v) AND (lim IS NULL OR abs(v) <= lim), false) AS beyond, frame_index - row_number() OVER (PARTITION BY episode_key, field, dim, v ORDER BY frame_index) AS run FROM c LEFT JOIN l USING (source_id)),
n AS (SELECT *, count(*) OVER (PARTITION BY episode_key, field, dim, v, run) AS times FROM r)
SELECT episode_key, frame_index, field, dim, CASE WHEN beyond THEN 'limit' ELSE 'stuck' END AS kind FROM n WHERE beyond OR times >= 8""",
    "p5_found": """
WITH s AS (SELECT DISTINCT episode_key, frame_index, step_time FROM steps WHERE isfinite(step_time)),
a AS (SELECT DISTINCT annotation_id, episode_key, said_at, known_at FROM annotations
      WHERE said_at IS NOT NULL AND known_at IS NOT NULL AND trim(content) <> '')
SELECT episode_key, frame_index, arg_max(annotation_id, (said_at, known_at, annotation_id)) AS annotation_id
FROM s JOIN a USING (episode_key) WHERE said_at <= step_time AND known_at <= step_time GROUP BY 1, 2""",
}
