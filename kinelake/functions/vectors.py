"""Vector columns: finite tests, normalization, padding, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(x: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def all_finite(v: Column) -> Column:
    """Whether every element is finite; null for a null vector."""
    return F.forall(v, is_finite)


def is_blank(s: Column) -> Column:
    """Null, empty or white space in any script."""
    return F.coalesce(~s.rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(True))


def zscore(v: Column, mean: Column, std: Column) -> Column:
    return F.zip_with(F.zip_with(v, mean, lambda x, m: x - m), std, lambda x, s: x / s)


def unzscore(v: Column, mean: Column, std: Column) -> Column:
    return F.zip_with(F.zip_with(v, std, lambda x, s: x * s), mean, lambda x, m: x + m)


def close(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    return F.abs(a - b) <= atol + rtol * F.abs(b)


def unverified_names(kind: str, width: Column) -> Column:
    """Names for channels whose source gives none."""
    return F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.concat(F.lit(f"unverified_{kind}_"), i.cast("string")))


def zero_padded(chunk: Column, horizon: int, width: Column) -> Column:
    """A chunk of vectors filled up to ``horizon`` with zero vectors."""
    zero = F.array_repeat(F.lit(0.0), width.cast("int"))
    return F.concat(chunk, F.array_repeat(zero, (F.lit(horizon) - F.size(chunk)).cast("int")))


def edge_padded(chunk: Column, horizon: int) -> Column:
    """A chunk filled up to ``horizon`` with its last vector."""
    return F.concat(chunk, F.array_repeat(F.element_at(chunk, -1), (F.lit(horizon) - F.size(chunk)).cast("int")))


def chunk_mask(valid: Column, horizon: int, width: Column) -> Column:
    """True where a padded chunk holds data, as [horizon, width]."""
    return F.transform(F.sequence(F.lit(0), F.lit(horizon - 1)), lambda i: F.array_repeat(i < valid, width.cast("int")))


def byte_tokens(text: Column, length: int = 192) -> Column:
    """The first ``length`` UTF-8 bytes plus one, zero-padded: a fixed-length input for small probes."""
    hexed = F.hex(F.substring(F.encode(text, "UTF-8"), 1, length))
    n = F.length(hexed) / 2
    ids = F.transform(F.sequence(F.lit(1), F.lit(length)), lambda i: F.when(i <= n, F.conv(F.substring(hexed, 2 * i - 1, F.lit(2)), 16, 10).cast("int") + 1).otherwise(0))
    return F.when(text.isNull(), F.array_repeat(F.lit(0), length)).otherwise(ids)


def concat_fields(*fields: Column) -> Column:
    """Several vectors joined in mapping order."""
    return F.concat(*fields)
