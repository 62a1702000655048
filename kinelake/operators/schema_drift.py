"""Schemas that drift between files: one feature table, and every change between successive files.

Payloads are read into canonical features (name, type, shape). Between two
successive versions the vanished and the appeared columns form a bipartite
graph: an edge joins columns whose value sketches (type and shape, or a profile
of real values) agree, weighted by name similarity; a minimum-cost matching
yields renames. Matched columns then share one unified name.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHANGE = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("field", "change", "was")]))

#: Spellings of one type.
TYPE_NAMES = {"double": "float64", "float": "float32", "long": "int64", "str": "string", "boolean": "bool"}


def canonical_type(value: object) -> str | None:
    if value is None:
        return None
    text = str(value).strip().lower()
    return TYPE_NAMES.get(text, text)


def canonical_shape(value: object) -> str:
    """The numbers of a shape in order, whatever its spelling: 8, "8", [8], "[8]"; "480x640x3"."""
    out: list[str] = []

    def walk(v: object) -> None:
        if isinstance(v, (list, tuple)):
            for x in v:
                walk(x)
        elif isinstance(v, bool) or v is None:
            return
        elif isinstance(v, (int, float)):
            out.append(str(int(v)) if float(v).is_integer() else repr(v))
        else:
            digits = ""
            for ch in str(v) + " ":
                if ch.isdigit():
                    digits += ch
                elif digits:
                    out.append(str(int(digits)))
                    digits = ""

    walk(value)
    return ",".join(out)


def canonical_version(value: object) -> str | None:
    if value is None:
        return None
    text = str(value).strip()
    return text[1:] if text[:1] in "vV" and text[1:2].isdigit() else text


def parse_payload(text: str | None) -> tuple[bool, str | None, list[tuple[str, str | None, str]]]:
    """(readable, version, features); unreadable is: null, no JSON, no object, or no features in it."""
    try:
        doc = json.loads(text) if isinstance(text, str) else None
    except ValueError:
        doc = None
    if not isinstance(doc, dict):
        return False, None, []
    inner = doc.get("metadata") if isinstance(doc.get("metadata"), dict) else {}
    raw = doc.get("features", inner.get("features"))
    if isinstance(raw, dict):
        pairs = list(raw.items())
    elif isinstance(raw, list):
        pairs = [(x.get("key", x.get("name")), x) for x in raw if isinstance(x, dict)]
    else:
        return False, None, []
    found: dict[str, tuple[str, str | None, str]] = {}
    for name, spec in pairs:
        if isinstance(name, str):
            spec = spec if isinstance(spec, dict) else {"dtype": spec}
            found[name] = (name, canonical_type(spec.get("dtype")), canonical_shape(spec.get("shape")))
    version = inner.get("codebase_version")
    return True, canonical_version(doc.get("codebase_version") if version is None else version), sorted(found.values())


def _typed(text: Column) -> Column:
    flat = F.lower(F.trim(text))
    names = F.create_map(*(F.lit(v) for pair in TYPE_NAMES.items() for v in pair))
    return F.coalesce(names[flat], flat)


def _numbers(text: Column) -> Column:
    """The whole numbers of a shape's JSON or text, in order."""
    found = F.regexp_extract_all(F.regexp_replace(text, r"\.0+(?![0-9])", ""), F.lit("[0-9]+"), 0)
    return F.coalesce(F.array_join(F.transform(found, lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")), ","), F.lit(""))


def _held(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it occurs there."""
    return F.get(F.transform(F.array(value), use), 0)


def _feature(name: Column, spec: Column) -> Column:
    kind = F.schema_of_variant(spec)
    plain = F.when(~kind.startswith("OBJECT") & ~kind.startswith("ARRAY"), F.try_variant_get(spec, "$", "string"))
    return F.struct(name.alias("name"), _typed(F.coalesce(F.try_variant_get(spec, "$.dtype", "string"), plain)).alias("dtype"), _numbers(F.try_variant_get(spec, "$.shape", "string")).alias("shape"))


def _features(raw: Column) -> Column:
    """The features of a list or an object of them, in order, null for anything else; of equal names the last."""
    name = lambda x: F.coalesce(F.try_variant_get(x, "$.key", "string"), F.try_variant_get(x, "$.name", "string"))
    listed = F.filter(F.try_variant_get(raw, "$", "array<variant>"), lambda x: F.schema_of_variant(x).startswith("OBJECT"))
    mapped = F.map_entries(F.try_variant_get(raw, "$", "map<string,variant>"))
    pairs = F.coalesce(F.transform(mapped, lambda e: F.struct(e["key"].alias("name"), e["value"].alias("spec"))), F.transform(listed, lambda x: F.struct(name(x).alias("name"), x.alias("spec"))))
    found = F.transform(F.filter(pairs, lambda p: p["name"].isNotNull()), lambda p: _feature(p["name"], p["spec"]))
    return _held(found, lambda every: F.filter(every, lambda x, i: ~F.exists(F.slice(every, i + 2, F.size(every)), lambda y: y["name"] == x["name"])))


def parsed(payload: Column) -> Column:
    """The same as ``parse_payload`` for a column: readable, version, features; all by the JVM."""
    text = lambda doc, path: F.try_variant_get(doc, path, "string")

    def read(doc: Column) -> Column:
        raw = F.coalesce(F.try_variant_get(doc, "$.features", "variant"), F.try_variant_get(doc, "$.metadata.features", "variant"))
        version = F.regexp_replace(F.trim(F.coalesce(text(doc, "$.metadata.codebase_version"), text(doc, "$.codebase_version"))), "^[vV](?=[0-9])", "")
        return F.struct(version.alias("version"), _features(raw).alias("features"))

    return _held(_held(F.try_parse_json(payload), read), lambda r: F.struct(r["features"].isNotNull().alias("readable"), r["version"].alias("version"), F.array_sort(r["features"]).alias("features")))


def _grams(name: str) -> set[str]:
    padded = f"^{name.lower()}$"
    return {padded[i : i + 2] for i in range(len(padded) - 1)}


def name_similarity(a: str, b: str) -> float:
    """Dice coefficient of character pairs, ignoring case."""
    x, y = _grams(a), _grams(b)
    return 2 * len(x & y) / max(len(x) + len(y), 1)


def assignment(cost: np.ndarray) -> list[tuple[int, int]]:
    """A minimum-cost matching of rows to columns (shortest augmenting paths); infinite cells never match."""
    rows, cols = cost.shape
    if not rows or not cols:
        return []
    flip = rows > cols
    c = cost.T if flip else cost
    big = (c[np.isfinite(c)].max(initial=0.0) + 1.0) * (max(c.shape) + 1)
    c = np.where(np.isfinite(c), c, big)
    n, m = c.shape
    u, v, owner, way = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        owner[0], j = i, 0
        best, used = np.full(m + 1, np.inf), np.zeros(m + 1, bool)
        while True:
            used[j] = True
            slack = c[owner[j] - 1] - u[owner[j]] - v[1:]
            better = ~used[1:] & (slack < best[1:])
            best[1:][better], way[1:][better] = slack[better], j
            free = np.where(used[1:], np.inf, best[1:])
            k = int(free.argmin()) + 1
            step = best[k]
            u[owner[used]] += step
            v[used] -= step
            best[~used] -= step
            j = k
            if owner[j] == 0:
                break
        while j:
            owner[j], j = owner[way[j]], way[j]
    pairs = [(int(owner[j]) - 1, j - 1) for j in range(1, m + 1) if owner[j]]
    pairs = [(i, j) for i, j in pairs if c[i, j] < big]
    return sorted((j, i) for i, j in pairs) if flip else sorted(pairs)


def compare_features(old: dict[str, tuple], new: dict[str, tuple], old_version: str | None, new_version: str | None) -> list[tuple[str, str, str | None]]:
    """The changes (field, change, was) from one version's features to the next one's.

    A rename needs a sketch (type and shape) with exactly one vanished and exactly
    one appeared column; any other vanished or appeared column is removed or added.
    """
    gone, come = [n for n in old if n not in new], [n for n in new if n not in old]
    out: list[tuple[str, str, str | None]] = []
    cost = np.full((len(gone), len(come)), np.inf)
    for i, a in enumerate(gone):
        rivals = sum(old[x] == old[a] for x in gone)
        for j, b in enumerate(come):
            if old[a] == new[b] and rivals == 1 and sum(new[x] == new[b] for x in come) == 1:
                cost[i, j] = 1.0 - name_similarity(a, b)
    matched = assignment(cost)
    paired_old, paired_new = {i for i, _ in matched}, {j for _, j in matched}
    out += [(come[j], "renamed", gone[i]) for i, j in matched]
    out += [(n, "removed", None) for i, n in enumerate(gone) if i not in paired_old]
    out += [(n, "added", None) for j, n in enumerate(come) if j not in paired_new]
    for n in new:
        if n in old:
            if old[n][0] != new[n][0]:
                out.append((n, "dtype_changed", old[n][0]))
            if old[n][1] != new[n][1]:
                out.append((n, "shape_changed", old[n][1]))
    if old_version != new_version:
        out.append(("codebase_version", "version_changed", old_version))
    return out


@F.pandas_udf(CHANGE)
def _compare(pair: pd.DataFrame) -> pd.Series:
    def features(cell: object) -> dict[str, tuple]:
        return {f["name"]: (f["dtype"], f["shape"]) for f in cell}

    out = []
    for a, b, va, vb in zip(pair["old"], pair["new"], pair["old_version"], pair["new_version"], strict=True):
        out.append([{"field": f, "change": c, "was": w} for f, c, w in compare_features(features(a), features(b), va, vb)])
    return pd.Series(out)


def feature_table(inspections: DataFrame) -> DataFrame:
    """One row per readable file: inspection_id, dataset_id, inspected_at, version, features (canonical)."""
    once = inspections.groupBy("inspection_id").agg(F.max(F.struct("dataset_id", "inspected_at", "payload")).alias("f")).select("inspection_id", "f.*")
    read = once.where(F.col("payload").isNotNull()).withColumn("p", parsed(F.col("payload"))).where("p.readable")
    return read.select("inspection_id", "dataset_id", "inspected_at", F.col("p.version").alias("version"), F.col("p.features").alias("features"))


def with_previous(files: DataFrame, bucket: Column) -> DataFrame:
    """Each file beside the one before it in its dataset, by ``inspected_at`` and then ``inspection_id``.

    Windows run within (dataset, bucket); a bucket's first file takes the last
    file of the dataset's bucket before, from a table of one row per bucket.
    So a dataset with a great share of all files spreads over many tasks.
    """
    files = files.where(F.col("dataset_id").isNotNull()).withColumn("bucket", F.coalesce(bucket, F.lit("")))
    item = F.struct("version", "features")
    order = Window.partitionBy("dataset_id", "bucket").orderBy("inspected_at", "inspection_id")
    inside = files.withColumn("previous", F.lag(item).over(order)).withColumn("first", F.row_number().over(order) == 1)
    ends = files.groupBy("dataset_id", "bucket").agg(F.max_by(item, F.struct("inspected_at", "inspection_id")).alias("end"))
    ends = ends.withColumn("carried", F.lag("end").over(Window.partitionBy("dataset_id").orderBy("bucket"))).drop("end")
    both = inside.join(ends, ["dataset_id", "bucket"])
    return both.withColumn("previous", F.when(F.col("first"), F.col("carried")).otherwise(F.col("previous"))).drop("bucket", "carried", "first")


def schema_changes(inspections: DataFrame) -> DataFrame:
    """Every change between successive readable files of a dataset.

    Returned: inspection_id (the later file's), dataset_id, field, change
    (added, removed, renamed, dtype_changed, shape_changed, version_changed), was.
    Null or unreadable payloads are skipped, as are files without a dataset;
    redelivered files count once; files of one moment follow by inspection_id; a
    null ``inspected_at`` comes first. Names are case-sensitive. Extra columns are
    ignored; an empty table gives none.
    """
    paired = with_previous(feature_table(inspections), F.date_format("inspected_at", "yyyy-MM")).where(F.col("previous").isNotNull())
    # only files that differ from the one before are matched
    paired = paired.where(~(F.col("previous.features") == F.col("features")) | ~F.col("previous.version").eqNullSafe(F.col("version")))
    pair = F.struct(F.col("previous.features").alias("old"), F.col("features").alias("new"), F.col("previous.version").alias("old_version"), F.col("version").alias("new_version"))
    changes = paired.select("inspection_id", "dataset_id", F.explode(_compare(pair)).alias("c"))
    return changes.select("inspection_id", "dataset_id", "c.field", "c.change", "c.was")


def profile_columns(df: DataFrame, sketch_size: int = 16) -> DataFrame:
    """A value sketch per column of a real table: type, share of nulls, mean width, share of distinct values, and the smallest value hashes.

    The bottom-k hashes estimate the overlap of two columns' values whatever the
    columns are called; width and distinctness compare columns whose values never
    recur. Columns: name, dtype, nulls, width, distinct, sketch.
    """
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        text = c.cast("string") if not isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType)) else F.to_json(c)
        parts.append(F.struct(F.lit(f.name).alias("name"), F.lit(canonical_type(f.dataType.simpleString())).alias("dtype"), c.isNull().alias("isnull"), F.length(text).alias("w"), F.xxhash64(text).alias("h")))
    long = df.select(F.explode(F.array(*parts)).alias("v")).select("v.*")
    kinds = long.groupBy("name", "dtype").agg(F.avg(F.col("isnull").cast("double")).alias("nulls"), F.coalesce(F.avg("w"), F.lit(0.0)).alias("width"), F.try_divide(F.approx_count_distinct(F.when(~F.col("isnull"), F.col("h"))).cast("double"), F.count("w")).alias("distinct"))
    hashes = long.where(~F.col("isnull")).select("name", "h").distinct().withColumn("r", F.row_number().over(Window.partitionBy("name").orderBy("h"))).where(F.col("r") <= sketch_size)
    return kinds.join(hashes.groupBy("name").agg(F.array_sort(F.collect_list("h")).alias("sketch")), "name", "left")


def column_likeness(a: dict, b: dict) -> float:
    """How alike two profiled columns are, 0 to 1: values, names, type, and the shape of the values."""
    sa, sb = set(a.get("sketch") or ()), set(b.get("sketch") or ())
    k = max(min(len(sa), len(sb)), 1)
    overlap = len(set(sorted(sa | sb)[:k]) & sa & sb) / k
    wa, wb = (1.0 + (c.get("width") or 0.0) for c in (a, b))
    shape = min(wa, wb) / max(wa, wb) * (1.0 - abs((a.get("distinct") or 0.0) - (b.get("distinct") or 0.0)))
    return 0.35 * overlap + 0.25 * name_similarity(a["name"], b["name"]) + 0.15 * (a["dtype"] == b["dtype"]) + 0.25 * max(shape, 0.0)


def match_columns(old: list[dict], new: list[dict], least: float = 0.5) -> dict[str, str]:
    """Map old column names to new ones: same names first, then a minimum-cost matching of the rest by their likeness."""
    names_old, names_new = {c["name"] for c in old}, {c["name"] for c in new}
    mapping = {n: n for n in sorted(names_old & names_new)}
    gone, come = [c for c in old if c["name"] not in mapping], [c for c in new if c["name"] not in mapping]
    likeness = np.array([[column_likeness(a, b) for b in come] for a in gone]).reshape(len(gone), len(come))
    mapping.update({gone[i]["name"]: come[j]["name"] for i, j in assignment(np.where(likeness >= least, 1 - likeness, np.inf))})
    return mapping


def unify(frames: list[DataFrame], least: float = 0.5) -> tuple[DataFrame, list[dict]]:
    """Read drifting versions into one table under the newest names, and report each change.

    Each version is profiled in one pass, matched to the next, renamed along the
    chain of matches and united by name; columns whose types differ become strings.
    """
    profiles = [[r.asDict() for r in profile_columns(f).collect()] for f in frames]  # one bounded row per column
    report: list[dict] = []
    names = [{f: f for f in frames[-1].columns}]
    for k in range(len(frames) - 2, -1, -1):
        step = match_columns(profiles[k], profiles[k + 1], least)
        names.insert(0, {f: names[0].get(step[f], step[f]) if f in step else f for f in frames[k].columns})
        types_old, types_new = {c["name"]: c["dtype"] for c in profiles[k]}, {c["name"]: c["dtype"] for c in profiles[k + 1]}
        for f in sorted(types_old):
            if f not in step:
                report.append({"version": k + 1, "field": f, "change": "removed"})
            elif step[f] != f:
                report.append({"version": k + 1, "field": step[f], "change": "renamed"})
            if f in step and types_new.get(step[f]) != types_old[f]:
                report.append({"version": k + 1, "field": step[f], "change": "dtype_changed"})
        report += [{"version": k + 1, "field": f, "change": "added"} for f in sorted(set(types_new) - set(step.values()))]
    renamed = [f.select(*(F.col(f"`{c}`").alias(names[k][c]) for c in f.columns)) for k, f in enumerate(frames)]
    kinds: dict[str, set[str]] = {}
    for f in renamed:
        for c, kind in f.dtypes:
            kinds.setdefault(c, set()).add(kind)
    clash = {c for c, k in kinds.items() if len(k) > 1}
    aligned = [f.select(*(F.col(f"`{c}`").cast("string").alias(c) if c in clash else F.col(f"`{c}`") for c in f.columns)) for f in renamed]
    out = aligned[0]
    for f in aligned[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out, report


def features_long(files: DataFrame) -> DataFrame:
    """The table of features, one row per file and feature, in canonical types and shapes."""
    return files.select("inspection_id", "dataset_id", "inspected_at", "version", F.explode("features").alias("f")).select("inspection_id", "dataset_id", "inspected_at", "version", "f.*")
