"""Declared rules for JSON documents: a path, the pattern its values match, and whether they must differ.

The same patterns judge a document on the driver and a column of many documents in Spark.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinelake.functions.hashing import RESERVED


class Rule(NamedTuple):
    """``path``: names joined by dots; ``[]`` steps into every element of a list, ``[+]`` also wants one at least."""

    path: str
    pattern: str
    distinct: bool = False


ANY = r"(?s).*\S.*"
NAME = rf"(?!(?i:{'|'.join(RESERVED)})\z)[A-Za-z0-9_-]+"
REVISION = r"[A-Za-z0-9_.-]*[A-Za-z0-9_-]"
#: A relative path of plain parts: no root, no way up, no empty part.
RELATIVE = r"(?!/)(?!(?:.*/)?\.\.(?:/|\z))(?!.*//)(?!.*\\).+"
SHA256 = r"[0-9a-fA-F]{64}"
COUNT = r"[0-9]+"

LOCK = [
    Rule("sources[].id", NAME, distinct=True),
    Rule("sources[].revision", REVISION),
    Rule("sources[].origin_namespace", ANY),
    Rule("sources[].license", ANY),
    Rule("sources[].files[].path", RELATIVE),
    Rule("sources[].files[].bytes", COUNT),
    Rule("sources[].files[].sha256", SHA256),
]


def values_at(doc: object, path: str) -> list:
    """All values at ``path``, None where the document ends before it."""
    found = [doc]
    for part in path.split("."):
        name = part.rstrip("[+]")
        found = [v.get(name) if isinstance(v, dict) else None for v in found]
        if part.endswith("[+]"):
            found = [x for v in found for x in (v if isinstance(v, list) and v else [None])]
        elif part.endswith("[]"):
            found = [x for v in found for x in (v or [])]
    return found


def broken(doc: object, rules: list[Rule]) -> list[str]:
    """What of ``doc`` breaks a rule, as readable lines; none if all is well. Equality ignores case."""
    told = []
    for rule in rules:
        values = values_at(doc, rule.path)
        pattern = re.compile(rule.pattern.replace(r"\z", r"\Z"))
        told += [f"{rule.path} is {v!r}" for v in values if v is None or not pattern.fullmatch(str(v))]
        if rule.distinct and len({str(v).casefold() for v in values}) < len(values):
            told.append(f"{rule.path} repeats a value")
    return told


def require(doc: object, rules: list[Rule], what: str) -> None:
    lines = broken(doc, rules)
    if lines:
        raise ValueError(f"{what}: " + "; ".join(lines))


def matches(column: Column, pattern: str) -> Column:
    """Whether the whole text matches; null does not."""
    return F.coalesce(column.rlike(rf"\A(?:{pattern})\z"), F.lit(False))
