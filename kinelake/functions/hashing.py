"""Digests, canonical JSON and hash-based splits, on the JVM and on the driver."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = "lab-demo-v1"


def canonical_text(value: object) -> str:
    """Compact JSON with sorted keys; non-ASCII stays, NaN and infinities are refused."""
    return json.dumps(value, sort_keys=True, ensure_ascii=False, allow_nan=False, separators=(",", ":"))


def object_digest(value: object) -> str:
    return hashlib.sha256(canonical_text(value).encode("utf-8")).hexdigest()


def json_digest(**fields: Column) -> Column:
    """SHA-256 of the canonical JSON of string and integer columns (keys sorted)."""
    return F.sha2(F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields)))), 256)


def split_of(group: Column, seed: str = DEFAULT_SEED) -> Column:
    """A fifth of the groups is held out: those whose digest starts with a multiple of five. A null group has no split."""
    head = F.conv(F.substring(json_digest(group=group, seed=F.lit(seed)), 1, 8), 16, 10).cast("bigint")
    return F.when(group.isNull(), None).when(head % 5 == 0, "validation").otherwise("train")


def capture_id(path: Column) -> Column:
    """The id of a capture from its relative path."""
    return F.concat(F.lit("xr_"), F.substring(json_digest(path=path), 1, 16))


def safe_id(name: Column) -> Column:
    """Letters, digits, underscore and hyphen only, and at least one (a trailing line break is not overlooked)."""
    return F.coalesce(name.rlike(r"\A[A-Za-z0-9_-]+\z"), F.lit(False))


#: Device names that a file of that name would collide with.
RESERVED = ["CON", "PRN", "AUX", "NUL", *[f"{p}{i}" for p in ("COM", "LPT") for i in range(1, 10)]]


def reserved_name(name: Column) -> Column:
    return F.upper(name).isin(*RESERVED)


def safe_revision(name: Column) -> Column:
    return F.coalesce(name.rlike(r"\A[A-Za-z0-9_.-]+\z") & ~name.isin(".", "..") & ~name.endswith("."), F.lit(False))
