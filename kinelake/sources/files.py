"""Files on the driver: digests, confinement, atomic JSON, bounded fetches; and digests of many files in Spark."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import tempfile
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE = 1 << 20
DIGEST = "path string, bytes bigint, sha256 string"


def sha256_file(path: Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def inside(root: Path, relative: str) -> Path:
    """The resolved path of ``relative``; leaving the root, also by a symbolic link, is refused."""
    base = Path(root).resolve()
    target = (base / relative).resolve()
    if target != base and base not in target.parents:
        raise ValueError(f"path leaves its root: {relative}")
    return target


def read_json(path: Path) -> object:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def save_json(path: Path, value: object) -> None:
    """Sorted, indented JSON, put in place as a whole; NaN is refused."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    text = json.dumps(value, sort_keys=True, indent=2, ensure_ascii=False, allow_nan=False)
    part = path.with_name(f".{path.name}.{os.getpid()}.part")
    try:
        part.write_text(text + "\n", encoding="utf-8")
        part.replace(path)
    finally:
        part.unlink(missing_ok=True)


def publish(target: Path, build: Callable[[Path], None]) -> None:
    """Build a folder beside ``target`` and rename it there when it is complete; an existing target is refused."""
    target = Path(target)
    if target.exists():
        raise FileExistsError(f"{target} exists; published folders never change")
    target.parent.mkdir(parents=True, exist_ok=True)
    work = Path(tempfile.mkdtemp(prefix=".staging-", dir=target.parent))
    try:
        build(work)
        work.rename(target)
    finally:
        shutil.rmtree(work, ignore_errors=True)


def obtain(url: str, path: Path, most_bytes: int, sha256: str | None = None, offline: bool = False) -> dict:
    """A file from the cache or the network, with its size and digest; too long or different ones are refused."""
    path = Path(path)
    if not path.exists():
        if offline:
            raise FileNotFoundError(f"not in the cache: {path}")
        path.parent.mkdir(parents=True, exist_ok=True)
        part = path.with_name(f".{path.name}.{os.getpid()}.part")
        try:
            with urllib.request.urlopen(url, timeout=60) as source, part.open("wb") as sink:
                size = 0
                while piece := source.read(PIECE):
                    size += len(piece)
                    if size > most_bytes:
                        raise ValueError(f"longer than {most_bytes} bytes: {url}")
                    sink.write(piece)
            if sha256 and sha256_file(part) != sha256:
                raise ValueError(f"other content than expected: {url}")
            part.replace(path)
        finally:
            part.unlink(missing_ok=True)
    size, digest = path.stat().st_size, sha256_file(path)
    if size > most_bytes:
        raise ValueError(f"longer than {most_bytes} bytes: {path}")
    if sha256 and digest != sha256:
        raise ValueError(f"other content than expected: {path}")
    return {"bytes": size, "sha256": digest}


def digests(spark: SparkSession, folder: str | Path) -> DataFrame:
    """path (below ``folder``), bytes, sha256 of every file there, empty and hidden ones too; a missing folder has none.

    ``folder`` is a path or a URI of a shared file system. The driver only lists it;
    executors hash piece by piece, so a file may have any size.
    """
    system, base = fs.FileSystem.from_uri(str(folder)) if "://" in str(folder) else (fs.LocalFileSystem(), str(Path(folder).resolve()))
    found = system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
    listed = [(f.path[len(base.rstrip("/")) + 1 :], f.size) for f in found if f.type == fs.FileType.File]
    slices = max(1, min(len(listed), 4 * spark.sparkContext.defaultParallelism))
    rows = spark.createDataFrame(listed, "path string, bytes bigint").repartition(slices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest = []
            for rel in batch.column(0).to_pylist():
                total = hashlib.sha256()
                with system.open_input_stream(f"{base}/{rel}") as f:
                    while piece := f.read(PIECE):
                        total.update(piece)
                digest.append(total.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digest, pa.string())], names=["path", "bytes", "sha256"])

    return rows.mapInArrow(run, DIGEST)


def copied(plan: DataFrame, source: Path, target: Path) -> None:
    """Copy the files of ``plan`` (path, bytes, sha256) by the executors; a copy with another digest fails and leaves nothing."""
    source, target = Path(source).resolve(), Path(target).resolve()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rel, want in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                to = inside(target, rel)
                to.parent.mkdir(parents=True, exist_ok=True)
                part = to.with_name(f".{to.name}.{uuid.uuid4().hex}.part")
                try:
                    shutil.copy2(inside(source, rel), part)
                    if sha256_file(part) != want:
                        raise ValueError(f"changed while it was copied: {rel}")
                    part.replace(to)
                finally:
                    part.unlink(missing_ok=True)
            yield batch

    plan.select("path", "sha256").mapInArrow(run, "path string, sha256 string").count()


def lock_mismatches(observed: DataFrame, lock_files: DataFrame) -> DataFrame:
    """Locked files that are absent or differ: path, problem. Both sides have path, bytes, sha256."""
    both = lock_files.join(observed.select("path", F.col("bytes").alias("got_bytes"), F.col("sha256").alias("got")), "path", "left")
    problem = F.when(F.col("got").isNull(), "absent").when(F.col("got_bytes") != F.col("bytes"), "size").when(F.col("got") != F.col("sha256"), "content")
    return both.withColumn("problem", problem).where("problem is not null").select("path", "problem")
